"""Exact ranked lexical search over buckets of impact vectors, ordered by their length.

A document is a sparse vector of integer impacts over the terms of the queries; its score is an inner
product with integer term weights. Documents are sorted by the length of their vectors and cut into
buckets. With the lowest score that can still enter a query's list, Cauchy-Schwarz drops whole buckets;
inside a bucket the angle left to a vector bounds its coordinates along the query's strongest terms,
first one by one and then together. Only what survives is scored, in integers. Every sixteenth bucket
is searched first, so that the others begin with a threshold.

Queries are worked on in blocks of bounded size, the documents in buckets of bounded size, so neither a
task nor the driver holds more than one block of queries and one bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.llm.common import cut_words, slices
from ledgerwatch.session import settle

QUERIES = 1024  # items in a block of queries, about
QUERY_BYTES = 4 << 20  # and their bytes, about, unless one item alone has more
BUCKET = 4096  # vectors in a bucket
SEED_EVERY = 16  # of so many buckets one is searched first
FOCUS = 6  # terms of a query whose coordinates are bounded
SLACK = 1e-9  # rounding of bounds in doubles, far below one unit of score

# The parts of the score.
WEIGHT, IMPACT, SATURATION, SLOPE, LENGTH_SHARE = 1000, 1_000_000_000, 1000, 12, 25

VECTORS = "doc_id long, n long, terms array<int>, counts array<long>"
BUCKETS = "number int, longest double, ids binary, known binary, sizes binary, terms binary, impacts binary"
FOUND = "query int, doc_id long, score long"


def _letters() -> np.ndarray:
    """For each byte the one it counts as: lower case, or a blank between terms."""
    table = np.arange(256, dtype=np.uint8)
    ascii_ = table < 128
    upper = (table >= ord("A")) & (table <= ord("Z"))
    lower = (table >= ord("a")) & (table <= ord("z"))
    digit = (table >= ord("0")) & (table <= ord("9"))
    return np.where(upper, table + 32, np.where(ascii_ & ~lower & ~digit, 32, table)).astype(np.uint8)


LETTERS = _letters()


def terms_of(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets and terms of each text: ASCII letters, lower-cased, digits, and all beyond ASCII; null has none."""
    text = pc.fill_null(text, "").cast(pa.large_string())
    _, offsets, data = text.buffers()
    offsets = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
    read = LETTERS[np.frombuffer(data, np.uint8)] if data else np.zeros(0, np.uint8)
    plain = pa.LargeStringArray.from_buffers(len(text), pa.py_buffer(offsets.copy()), pa.py_buffer(read))
    return cut_words(plain)


@dataclass(frozen=True)
class Queries:
    """A block of queries: their ids, and term numbers with how often each query holds them."""

    ids: list
    vocabulary: pa.Array
    bounds: np.ndarray
    terms: np.ndarray
    repeats: np.ndarray


def read_queries(ids: list, texts: list[str | None]) -> Queries:
    bounds, words = terms_of(pa.array(texts, pa.string()))
    coded = pc.dictionary_encode(words)
    rows = np.repeat(np.arange(len(ids)), np.diff(bounds))
    pairs = np.stack([rows, np.asarray(coded.indices, dtype=np.int64)], 1).reshape(-1, 2)
    pairs, repeats = np.unique(pairs, axis=0, return_counts=True)
    return Queries(ids, coded.dictionary, np.searchsorted(pairs[:, 0], np.arange(len(ids) + 1)), pairs[:, 1], repeats)


def vectors(docs: DataFrame, vocabulary: pa.Array) -> DataFrame:
    """(doc_id, n, terms, counts) of the documents with a term: all their terms, and those of the vocabulary."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)  # of one block of queries
    inputs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in slices(batches):
            bounds, words = terms_of(batch.column("text"))
            n = np.diff(bounds)
            number = pc.index_in(words, value_set=known)
            met = np.flatnonzero(np.asarray(number.is_valid()))
            rows = np.searchsorted(bounds, met, side="right") - 1
            key = rows * max(1, len(known)) + np.asarray(number.drop_null(), dtype=np.int64)
            key, counts = np.unique(key, return_counts=True)
            rows, terms = np.divmod(key, max(1, len(known)))
            offsets = pa.array(np.searchsorted(rows, np.arange(len(n) + 1)), pa.int32())
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(n),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int64))),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )
            yield out.filter(pa.array(n > 0))

    return inputs.mapInArrow(run, VECTORS)


def term_weights(found: np.ndarray, documents: int) -> np.ndarray:
    """Integer weight of each term from the number of documents that hold it."""
    return np.array([math.floor(WEIGHT * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in found], np.int64)


def impacts(counts: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * documents) // length
    return (IMPACT * counts) // (SATURATION * counts + SLOPE * m)


def buckets(rows: DataFrame, weights: np.ndarray, documents: int, length: int) -> DataFrame:
    """The vectors with a term of the vocabulary, sorted by length, longest first, in buckets."""
    held = rows.sparkSession.sparkContext.broadcast(weights)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes = np.asarray(pc.list_value_length(batch.column("terms")))
            terms = np.asarray(batch.column("terms").flatten())
            n = np.repeat(np.asarray(batch.column("n")), sizes)
            value = impacts(np.asarray(batch.column("counts").flatten()), n, documents, length)
            squares = np.concatenate([[0.0], np.cumsum(held.value[terms] * value.astype(float) ** 2)])
            ends = np.cumsum(sizes)
            norm = np.sqrt(np.maximum(squares[ends] - squares[ends - sizes], 0))
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("at"), batch.column("doc_id"), pa.array(norm),
                    pa.ListArray.from_arrays(offsets, pa.array(terms)), pa.ListArray.from_arrays(offsets, pa.array(value)),
                ],
                names=["at", "doc_id", "norm", "terms", "impacts"],
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()  # the longest of all are in bucket 0 of the first task
        for batch in slices(batches, BUCKET):
            ids = batch.column("doc_id")
            row = {
                "number": number, "longest": batch.column("norm")[0].as_py(),
                "ids": np.asarray(pc.fill_null(ids, 0)).tobytes(),
                "known": np.asarray(ids.is_valid()).tobytes(),
                "sizes": np.asarray(pc.list_value_length(batch.column("terms"))).tobytes(),
                "terms": np.asarray(batch.column("terms").flatten()).tobytes(),
                "impacts": np.asarray(batch.column("impacts").flatten()).tobytes(),
            }
            number += 1
            yield pa.RecordBatch.from_pylist([row], schema=_BUCKET_SCHEMA)

    # `at` tells equal rows apart, so that copies are dealt out like any others
    numbered = rows.where("size(terms) > 0").withColumn("at", F.monotonically_increasing_id())
    measured = numbered.mapInArrow(measure, "at long, doc_id long, norm double, terms array<int>, impacts array<long>")
    order = [F.desc("norm"), F.asc("at")]
    return measured.repartitionByRange(*order).sortWithinPartitions(*order).drop("at").mapInArrow(pack, BUCKETS)


_BUCKET_SCHEMA = pa.schema(
    [("number", pa.int32()), ("longest", pa.float64())]
    + [(name, pa.binary()) for name in ("ids", "known", "sizes", "terms", "impacts")]
)


class Bucket:
    """One bucket in a task: its vectors by row, and by term with coordinates scaled to unit length."""

    def __init__(self, row: dict, weights: np.ndarray) -> None:
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.known = np.frombuffer(row["known"], bool)
        sizes = np.frombuffer(row["sizes"], np.int32).astype(np.int64)
        self.terms = np.frombuffer(row["terms"], np.int32)
        self.impacts = np.frombuffer(row["impacts"], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.longest = row["longest"]
        rows = np.repeat(np.arange(len(sizes)), sizes)
        value = np.sqrt(weights[self.terms]) * self.impacts
        self.norms = np.sqrt(np.bincount(rows, value**2, len(sizes)))
        by_term = np.argsort(self.terms, kind="stable")
        self.rows = rows[by_term]
        self.unit = value[by_term] / np.maximum(self.norms[self.rows], 1e-300)
        self.at = np.searchsorted(self.terms[by_term], np.arange(len(weights) + 1))

    def survivors(self, terms: np.ndarray, strength: np.ndarray, least: float) -> np.ndarray:
        """The vectors whose product with the query (terms and unit coordinates) may reach `least`.

        `least` is the threshold over the query's length. A vector of length l needs a cosine of
        least / l, so it lies within an angle of the query, and each coordinate within that angle of
        the query's own; those of a focus set also together, with Cauchy-Schwarz for all the rest.
        """
        needed = np.minimum(least / np.maximum(self.norms, 1e-300) * (1 - SLACK) - SLACK, 1.0)
        alive = self.norms * (1 + SLACK) >= least
        widest = np.arccos(np.clip(needed, -1, 1))
        product, square, used = np.zeros(len(self.norms)), np.zeros(len(self.norms)), 0.0
        for k in range(min(FOCUS, len(terms))):
            t, q = terms[k], strength[k]
            rows, unit = self.rows[self.at[t] : self.at[t + 1]], self.unit[self.at[t] : self.at[t + 1]]
            coordinate = np.zeros(len(self.norms))
            coordinate[rows] = unit
            own = math.acos(min(1.0, q))
            low = np.cos(np.minimum(own + widest, np.pi))
            high = np.cos(np.maximum(own - widest, 0))
            alive &= (coordinate >= low - SLACK) & (coordinate <= high + SLACK)
            product += q * coordinate
            square += coordinate**2
            used += q * q
        rest = np.sqrt(np.maximum(1 - square, 0) * max(1 - used, 0.0))
        return np.flatnonzero(alive & (product + rest + SLACK >= needed))

    def scores(self, rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores of some vectors; `weight` has the query's integer weight of every term."""
        if len(rows) == len(self.ids):
            return np.add.reduceat(weight[self.terms] * self.impacts, self.starts)
        sizes = self.ends[rows] - self.starts[rows]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(self.starts[rows] - (ends - sizes), sizes)
        return np.add.reduceat(weight[self.terms[places]] * self.impacts[places], ends - sizes)


def search(found: DataFrame, queries: Queries, weights: np.ndarray, k: int, least: np.ndarray) -> DataFrame:
    """(query, doc_id, score): of each bucket the k best of every query that reach its threshold in `least`."""
    held = found.sparkSession.sparkContext.broadcast((queries, weights, least))  # one block of queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights, least = held.value
        threshold = least.copy()  # rises as this task finds more
        best = [np.zeros(0, np.int64)] * len(queries.ids)
        plans = []
        for r in range(len(queries.ids)):
            terms, repeats = (x[queries.bounds[r] : queries.bounds[r + 1]] for x in (queries.terms, queries.repeats))
            value = repeats * np.sqrt(weights[terms])
            order = np.argsort(-value, kind="stable")
            length = math.sqrt(float((value**2).sum()))
            plans.append((terms, repeats, terms[order], value[order] / length if length else value, length))
        full = np.zeros(len(weights), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                bucket = Bucket(row, weights)
                out = []
                for r, (terms, repeats, strongest, strength, length) in enumerate(plans):
                    if not length or length * bucket.longest * (1 + SLACK) < threshold[r]:
                        continue
                    rows = bucket.survivors(strongest, strength, threshold[r] / length)
                    if not len(rows):
                        continue
                    full[terms] = repeats * weights[terms]
                    score = bucket.scores(rows, full)
                    full[terms] = 0
                    reach = score >= threshold[r]
                    rows, score = rows[reach], score[reach]
                    if len(rows) > k:
                        top = np.lexsort((bucket.ids[rows], ~bucket.known[rows], -score))[:k]
                        rows, score = rows[top], score[top]
                    if not len(rows):
                        continue
                    best[r] = -np.sort(-np.concatenate([best[r], score]))[:k]
                    if len(best[r]) == k:
                        threshold[r] = max(threshold[r], best[r][-1])
                    out.append((np.full(len(rows), r, np.int32), rows, score))
                if out:
                    which, rows, score = (np.concatenate(x) for x in zip(*out))
                    ids = pa.array(bucket.ids[rows], mask=~bucket.known[rows])
                    yield pa.RecordBatch.from_arrays([pa.array(which), ids, pa.array(score)], names=["query", "doc_id", "score"])

    return found.mapInArrow(run, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _rank_block(docs: DataFrame, queries: Queries, k: int) -> DataFrame | None:
    """(query, rank, doc_id, score) for one block of queries, or None if no document holds any of their terms."""
    if not len(queries.vocabulary):
        return None
    rows, seen = settle(vectors(docs, queries.vocabulary), F.sum("n").alias("length"))
    if not seen["rows"]:
        return None
    holding = np.zeros(len(queries.vocabulary), np.int64)
    for term, documents in rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # of one vocabulary
        holding[term] = documents
    weights = term_weights(holding, seen["rows"])
    found, _ = settle(buckets(rows, weights, seen["rows"], seen["length"]))
    none = np.ones(len(queries.ids), np.int64)  # a score above 0
    first, _ = settle(search(found.where(F.col("number") % SEED_EVERY == 0), queries, weights, k, none))
    least = none.copy()
    for query, score in _best(first, k).where(F.col("rank") == k).select("query", "score").collect():  # one a query
        least[query] = score
    rest = search(found.where(F.col("number") % SEED_EVERY != 0), queries, weights, k, least)
    return _best(first.unionByName(rest), k)


def rank(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents with the highest scores above 0 of every item, or all there are.

    Equal scores go by ascending doc_id, a null id last. A document row given twice counts and is ranked
    twice; an item given twice is asked once, by its least text. Null, empty and blank texts have no
    terms: as documents they do not count, as items they have no row. Other columns are not read.
    Scores are 64-bit integers: they hold for items of up to some million terms.
    """
    spark = docs.sparkSession
    asked = items.select("item_id", F.col("text").cast("string").alias("text")).groupBy("item_id").agg(F.min("text").alias("text"))
    asked, seen = settle(asked, F.sum(F.octet_length("text")).alias("bytes"))
    blocks = max(1, -(-seen["rows"] // QUERIES), -(-(seen["bytes"] or 0) // QUERY_BYTES))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    kind = items.schema["item_id"].dataType.simpleString()
    results = []
    for number in range(blocks):
        some = asked.where(block == number).collect()  # one block of queries
        queries = read_queries([r.item_id for r in some], [r.text for r in some])
        ranked = _rank_block(docs, queries, k) if some else None
        if ranked is not None:
            names = spark.createDataFrame(list(enumerate(queries.ids)), f"query int, item_id {kind}")
            results.append(ranked.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    result = results[0]
    for more in results[1:]:
        result = result.unionByName(more)
    return result
