"""Quality scores by a factorisation machine over hashed words, structure and metadata.

A text is a sparse vector: its distinct words, hashed and weighted to unit length, one bin for
each statistic of its structure, and one for each metadata column asked for. The model has a
weight and a short vector for each feature. All pairwise interactions cost linear time, since
the sum over pairs of <v_i, v_j> x_i x_j is half of (sum of v_i x_i)^2 less the sum of (v_i x_i)^2.

The model is fitted on the driver on a sample of labelled rows with a fixed bound; every row is
scored in tasks, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.llm.common import slices, word_hashes, words_of

WORDS = 1 << 14  # features for hashed words
BINS = 24  # features for each statistic or numeric metadata column
TRAIN_ROWS = 8_000  # bound on the labelled rows that are fitted
RANK, EPOCHS, BATCH, RATE, DECAY = 8, 6, 128, 0.08, 1e-4

SCORED_BYTES = 1 << 20  # of rows scored side by side

# Kinds of byte whose shares describe a text's structure.
KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "space": b" \t",
    "line": b"\n",
    "stop": b".,;:?'\"-()",
    "mark": b"!#$%&*+/<=>@[\\]^_`{|}~",
    "beyond": bytes(range(128, 256)),
}
STATISTICS = (*KINDS, "kinds_of_word", "repeated", "word_length", "words", "short", "fullest")


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray  # float32, by feature
    vectors: np.ndarray  # float32, by feature and factor


def _runs(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i + 1]]."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _share(x: np.ndarray) -> np.ndarray:
    return np.minimum(np.sqrt(np.clip(x, 0, 1)) * (BINS - 1), BINS - 1).astype(np.int64)


def _size(x: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(1 + np.maximum(x, 0)), BINS - 1).astype(np.int64)


def text_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and value of the words and statistics of each text. Null is as empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    n = len(texts)
    raw = np.frombuffer("".join(texts.to_pylist()).encode(), np.uint8)
    bytes_at = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))]).astype(np.int64)
    sizes = np.maximum(np.diff(bytes_at), 1)
    stats = []
    for members in KINDS.values():
        table = np.zeros(256, np.uint8)
        table[list(members)] = 1
        stats.append(_share(_runs(table[raw], bytes_at) / sizes))
    bounds, words = words_of(texts)
    counts = np.diff(bounds)
    some = np.maximum(counts, 1)
    hashes = word_hashes(words)
    lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) if len(words) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(n), counts)
    same = np.zeros(len(hashes))
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    bucket = (hashes % np.uint64(WORDS)).astype(np.int64)
    cells, times = np.unique(row * WORDS + bucket, return_counts=True)
    row, bucket = cells // WORDS, cells % WORDS
    kinds = np.bincount(row, minlength=n)
    fullest = np.zeros(n)
    np.maximum.at(fullest, row, times)
    stats += [
        _share(kinds / some), _share(_runs(same, bounds) / some), _size(_runs(lengths, bounds) / some),
        _size(counts), _share(_runs((lengths <= 3).astype(float), bounds) / some), _share(fullest / some),
    ]
    each = np.arange(n)
    rows = [row, *[each] * len(stats)]
    features = [bucket, *[WORDS + k * BINS + s for k, s in enumerate(stats)]]
    values = [1 / np.sqrt(np.maximum(kinds, 1))[row], *[np.ones(n)] * len(stats)]
    return np.concatenate(rows), np.concatenate(features), np.concatenate(values).astype(np.float32)


def _by_row(rows: np.ndarray, features: np.ndarray, values: np.ndarray, n: int):
    order = np.argsort(rows, kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))])
    return bounds, features[order], values[order]


def metadata_features(columns: list[pa.Array], first: int) -> tuple[np.ndarray, np.ndarray]:
    """One feature a column: a bin of the size of a number, a hashed bin of anything else; null has its own."""
    rows, features = [], []
    for k, column in enumerate(columns):
        if pa.types.is_integer(column.type) or pa.types.is_floating(column.type):
            given = pc.fill_null(column.cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False)
            found = np.where(np.isnan(given), BINS - 1, np.minimum(_size(np.nan_to_num(given, posinf=2.0**60)), BINS - 2))
        else:
            found = (word_hashes(pc.fill_null(column.cast(pa.large_string()), "\x00")) % np.uint64(BINS)).astype(np.int64)
        rows.append(np.arange(len(column)))
        features.append(first + k * BINS + found)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *rows]), np.concatenate([none, *features])


def dimensions(metadata: int) -> int:
    return WORDS + (len(STATISTICS) + metadata) * BINS


def features_of(texts: pa.Array, columns: list[pa.Array]):
    """(bounds, features, values): the sparse vector of row i is at bounds[i]:bounds[i + 1]."""
    rows, features, values = text_features(texts)
    more_rows, more = metadata_features(columns, WORDS + len(STATISTICS) * BINS)
    return _by_row(
        np.concatenate([rows, more_rows]), np.concatenate([features, more]),
        np.concatenate([values, np.ones(len(more), np.float32)]), len(texts),
    )


def margins(model: Model, bounds: np.ndarray, features: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The linear part and all pairs by the sum-of-squares identity. Every row has some feature."""
    if len(bounds) < 2:
        return np.zeros(0)
    at = bounds[:-1]
    linear = np.add.reduceat(model.weights[features] * values, at)
    terms = model.vectors[features] * values[:, None]
    sums, squares = np.add.reduceat(terms, at), np.add.reduceat(terms * terms, at)
    return model.bias + linear + 0.5 * (sums * sums - squares).sum(1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(bounds: np.ndarray, features: np.ndarray, values: np.ndarray, labels: np.ndarray, size: int, seed: int = 1) -> Model:
    """Logistic loss, steps scaled by past gradients; the same rows give the same model."""
    rng = np.random.default_rng(seed)
    rate = labels.mean() if len(labels) else 0.5
    prior = float(np.log((rate * len(labels) + 1) / ((1 - rate) * len(labels) + 1))) if len(labels) else 0.0
    weights, vectors = np.zeros(size, np.float32), rng.normal(0, 0.02, (size, RANK)).astype(np.float32)
    seen_w, seen_v, bias = np.full(size, 1e-6, np.float32), np.full((size, RANK), 1e-6, np.float32), prior
    for _ in range(EPOCHS if len(labels) else 0):
        order = rng.permutation(len(labels))
        for start in range(0, len(order), BATCH):
            rows = order[start : start + BATCH]
            lengths = bounds[rows + 1] - bounds[rows]
            own = np.concatenate([[0], np.cumsum(lengths)])
            source = np.repeat(bounds[rows] - own[:-1], lengths) + np.arange(own[-1])
            f, x = features[source], values[source]
            terms = vectors[f] * x[:, None]
            sums = np.add.reduceat(terms, own[:-1])
            model = Model(bias, weights, vectors)
            error = sigmoid(margins(model, own, f, x)) - labels[rows]
            each = np.repeat(error, lengths).astype(np.float32) * x / len(rows)
            of_v = each[:, None] * (np.repeat(sums, lengths, axis=0) - terms)
            touched, place = np.unique(f, return_inverse=True)
            grad_w = np.bincount(place, each, len(touched)).astype(np.float32) + DECAY * weights[touched]
            grad_v = np.stack([np.bincount(place, of_v[:, k], len(touched)) for k in range(RANK)], 1).astype(np.float32)
            grad_v += DECAY * vectors[touched]
            seen_w[touched] += grad_w**2
            seen_v[touched] += grad_v**2
            weights[touched] -= RATE * grad_w / np.sqrt(seen_w[touched])
            vectors[touched] -= RATE / 4 * grad_v / np.sqrt(seen_v[touched])
            bias -= RATE * float(error.mean())
    return Model(bias, weights, vectors)


def one_label(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) for ids whose label is given once or always alike; null ids and labels have none."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    agreed = own.groupBy("doc_id").agg(F.min(label).alias("_low"), F.max(label).alias("_high"))
    return agreed.where("_low = _high").select("doc_id", F.col("_low").cast("int").alias("label"))


def sample_labels(labels: DataFrame, label: str, learn_from: Column, most: int) -> DataFrame:
    """At most `most` labelled ids that may be learned from, chosen by a hash of the id."""
    return one_label(labels, label).where(learn_from).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def train(
    docs: DataFrame, labels: DataFrame, label: str, learn_from: Column, metadata: tuple[str, ...] = (),
    most: int = TRAIN_ROWS, seed: int = 1,
) -> Model:
    """Fit the model on the labelled rows that `learn_from` allows, `most` at most.

    Without such rows the model says one half for all.
    """
    chosen = sample_labels(labels, label, learn_from, most)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), *[F.col(c).alias(f"_m{k}") for k, c in enumerate(metadata)])
    rows = rows.join(F.broadcast(chosen), "doc_id")  # `most` pairs of numbers at most

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bounds, features, values = features_of(batch.column("text"), [batch.column(f"_m{k}") for k in range(len(metadata))])
            offsets = pa.array(bounds.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.ListArray.from_arrays(offsets, pa.array(features.astype(np.int32))),
                 pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.float32)))],
                names=["doc_id", "label", "features", "values"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    table = rows.mapInArrow(vectors, f"doc_id {kind}, label int, features array<int>, values array<float>")
    # repeated rows of an id are one example, so the bound holds
    sample = table.dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id")
    lists, values = sample["features"].combine_chunks(), sample["values"].combine_chunks()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    return fit(
        bounds, lists.flatten().to_numpy(), values.flatten().to_numpy(),
        sample["label"].to_numpy().astype(np.float64), dimensions(len(metadata)), seed,
    )


def score(docs: DataFrame, model: Model, metadata: tuple[str, ...] = (), name: str = "score") -> DataFrame:
    """All columns of the rows, nested as `row`, and the score from 0 to 1. Empty and null texts have one too."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size, under 1 MB
    # the text crosses to Python once, inside its row
    inputs = docs.select(F.struct("*").alias("row"), *[F.col(c).alias(f"_m{k}") for k, c in enumerate(metadata)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=SCORED_BYTES):
            text = pc.struct_field(batch.column("row"), "text").cast(pa.string())
            found = features_of(text, [batch.column(f"_m{k}") for k in range(len(metadata))])
            values = sigmoid(margins(held.value, *found).astype(np.float64))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(values, pa.float64())], names=["row", name])

    schema = T.StructType([inputs.schema["row"], T.StructField(name, T.DoubleType())])
    return inputs.mapInArrow(run, schema)
