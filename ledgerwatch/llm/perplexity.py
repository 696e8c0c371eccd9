"""Quality rules with n-gram perplexity: text statistics, a language model, and bands for each language.

The model is modified Kneser-Ney over bytes of words joined by one space, counted by Spark over all
documents. An n-gram is packed into one long, so that its context and its shorter form are a shift and
a mask away, and no key can have more than 256 followers or predecessors. Each order is an aggregate of
the order above, and two joins give its probabilities.

The most frequent n-grams, a fixed number at most, go to every task as an array of sorted hashes with
fixed-point log probabilities. What it does not hold, seen or unseen, is answered by joins with the
written tables, through all orders. All sums are integers, so no order of rows changes a verdict.

A document is rejected if its bits per byte lie outside the band of its language and length class:
the median of all such documents, and a multiple of the median deviation to both sides.
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

from ledgerwatch.functions.lookups import join_back, make_lookup
from ledgerwatch.llm.common import cut_words, mixed, shingle_hashes, slices
from ledgerwatch.session import settle

ORDER = 5  # bytes in an n-gram, 7 at most
HEAD = 1 << 20  # n-grams that every task holds, 12 bytes each
HELD = 1 << 19  # distinct n-grams that a counting task gathers before it hands them on
AT_ONCE = 1 << 18  # n-grams looked up side by side
TEXT_BYTES = 1 << 20  # of texts worked on side by side
UNIT = 1 << 16  # log probabilities are whole numbers of 1/UNIT bits
WIDTH = 6  # median deviations from the middle of a band to its edges
NARROWEST = 10  # thousandths of a bit that count as deviation, at least
FEWEST = 30  # documents whose median deviation counts

MIN_WORDS, REPEAT_WIDTH, REPEAT_PERCENT = 20, 8, 30
SYMBOLS = "#*$%&|<>"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


# --- base statistics ------------------------------------------------------------------


def per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[bounds])


def repeated_lines(text: pa.Array) -> np.ndarray:
    """Lines with a word that are equal to an earlier line of their text."""
    lists = pc.split_pattern(pc.fill_null(text, "").cast(pa.large_string()), "\n")
    lines, bounds = lists.flatten(), np.asarray(lists.offsets)
    full = np.flatnonzero(np.asarray(pc.greater(pc.binary_length(pc.ascii_trim_whitespace(lines)), 0)))
    codes = np.asarray(pc.dictionary_encode(lines).indices, dtype=np.int64)[full]
    rows = np.searchsorted(bounds - bounds[0], full, side="right") - 1
    first = np.unique(np.stack([rows, codes], 1).reshape(-1, 2), axis=0)[:, 0]
    return np.bincount(rows, minlength=len(text)) - np.bincount(first, minlength=len(text))


def words_repeated(codes: np.ndarray, bounds: np.ndarray, width: int = REPEAT_WIDTH) -> np.ndarray:
    """Words in windows of `width` words that their text holds twice or more."""
    n = np.diff(bounds)
    starts, hashes = shingle_hashes(bounds, mixed(codes.astype(np.uint64) + np.uint64(1)), width)
    rows = np.repeat(np.arange(len(n)), np.diff(starts))
    first = bounds[:-1][rows] + np.arange(len(rows)) - starts[:-1][rows]
    whole = n[rows] >= width
    if not whole.any():
        return np.zeros(len(n), np.int64)
    rows, hashes, first = rows[whole], hashes[whole], first[whole]
    order = np.lexsort((hashes, rows))
    same = (hashes[order][1:] == hashes[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    twice = first[order[np.append(same, False) | np.append(False, same)]]
    covers = np.zeros(len(codes) + 1, np.int64)
    np.add.at(covers, twice, 1)
    np.add.at(covers, twice + width, -1)
    return per_row(np.cumsum(covers)[:-1] > 0, bounds)


# --- n-grams of a batch ------------------------------------------------------------------


def joined(words: pa.Array, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of the texts, their words joined by one space."""
    text = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(bounds), words), pa.scalar(" ", words.type))
    _, offsets, data = text.buffers()
    offsets = np.frombuffer(offsets, np.int64)[: len(text) + 1]
    return offsets, np.frombuffer(data, np.uint8)[: offsets[-1]] if data else np.zeros(0, np.uint8)


def packed(offsets: np.ndarray, data: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and packed n-grams of the texts: one ends at each byte, one at a closing zero byte.

    Before a text there are as many zero bytes as a context has, one at least. A text without bytes has no n-gram.
    """
    sizes = np.diff(offsets)
    full = sizes > 0
    counts = np.where(full, sizes + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    lead = max(1, order - 1)
    # every text that is not empty takes its bytes and `lead` zeros before them, and one zero ends all
    number = np.cumsum(full) - 1
    start = offsets[:-1] + (number + 1) * lead
    line = np.zeros(len(data) + (int(full.sum()) + 1) * lead + 1, np.uint64)
    place = np.arange(len(data)) + np.repeat((number + 1) * lead, sizes)
    line[place] = data
    keys = np.zeros(len(line), np.uint64)
    for back in range(order):
        keys[back:] |= line[: len(line) - back] << np.uint64(8 * back)
    at = np.arange(bounds[-1]) + np.repeat(start - bounds[:-1], counts)
    return bounds, keys[at].astype(np.int64)


def tally(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, in order, with its count."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    if counts is None:
        return keys[heads], np.diff(np.append(heads, len(keys)))
    return keys[heads], np.add.reduceat(counts, heads) if len(heads) else counts


def counted(docs: DataFrame, order: int) -> DataFrame:
    """(key, c): how often each n-gram of full order occurs in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            keys, counts = tally(*(np.concatenate(x) for x in zip(*held)))
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "c"])

        for batch in slices(batches, size=TEXT_BYTES):
            bounds, words = cut_words(batch.column(0))
            held.append(tally(packed(*joined(words, bounds), order)[1]))
            size += len(held[-1][0])
            if size > 2 * HELD:
                held = [tally(*(np.concatenate(x) for x in zip(*held)))]
                size = len(held[0][0])
                if size > HELD:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    texts = docs.select(F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))


# --- the model ------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """For each order from 1: n-grams with their log probability, and contexts with their backoff, in 1/UNIT bits.

    `hashes` and `values` are the n-grams of full order that every task holds, by hash.
    """

    order: int
    grams: list[DataFrame]  # key, c, bits
    contexts: list[DataFrame]  # context, bits
    hashes: np.ndarray
    values: np.ndarray


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """What counts of one, two and more give up; the customary fixed values where counts of counts do not say."""
    if min(n1, n2, n3, n4) > 0:
        y = n1 / (n1 + 2 * n2)
        found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
        if all(0 < d < k for k, d in enumerate(found, 1)):
            return found
    return 0.5, 1.0, 1.5


def bits(p: Column) -> Column:
    return F.round(-F.log2(p) * UNIT).cast("long")


def train(docs: DataFrame, order: int = ORDER, head: int = HEAD) -> Model:
    """A model of all texts. Without any word there is no n-gram, and every byte is as likely as another."""
    spark = docs.sparkSession
    tables, cuts = [], []
    for k in range(order, 0, -1):
        if k == order:
            grams = counted(docs, order)
        else:  # in how many contexts one byte longer the n-gram occurs
            shorter = F.col("key").bitwiseAND(F.lit((1 << 8 * k) - 1))
            grams = tables[0].groupBy(shorter.alias("key")).agg(F.count(F.lit(1)).alias("c"))
        grams, seen = settle(grams, *[F.count_if(F.col("c") == n).alias(f"n{n}") for n in (1, 2, 3, 4)])
        tables.insert(0, grams)
        cuts.insert(0, discounts(*[seen[f"n{n}"] for n in (1, 2, 3, 4)]))
    contexts = []
    lower = None
    for k, (grams, (d1, d2, d3)) in enumerate(zip(tables, cuts), 1):
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        context = F.shiftright("key", 8)
        totals = grams.groupBy(context.alias("context")).agg(
            F.sum("c").alias("total"),
            ((F.count_if(F.col("c") == 1) * d1 + F.count_if(F.col("c") == 2) * d2 + F.count_if(F.col("c") > 2) * d3)
             / F.sum("c")).alias("back"),
        )
        rows = grams.withColumn("context", context).join(totals, "context")
        if lower is None:
            rows = rows.withColumn("below", F.lit(1 / 256))
        else:
            below = lower.select(F.col("key").alias("shorter"), F.col("p").alias("below"))
            rows = rows.withColumn("shorter", F.col("key").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))).join(below, "shorter")
        p = (F.col("c") - cut) / F.col("total") + F.col("back") * F.col("below")
        lower, _ = settle(rows.select("key", "c", p.alias("p"), bits(p).alias("bits")))
        tables[k - 1] = lower
        contexts.append(totals.select("context", bits(F.col("back")).alias("bits")))
    # the least count that leaves no more than `head` n-grams, from counts of counts in powers of two
    level = F.floor(F.log2("c")).cast("int")
    most = 0
    threshold = None
    for floor, rows in sorted(lower.groupBy(level.alias("floor")).count().collect(), reverse=True):  # 64 rows at most
        most += rows
        if most > head:
            break
        threshold = 1 << floor
    kept = lower.where(F.col("c") >= threshold) if threshold else lower.limit(0)
    kept = kept.select("key", "bits").toArrow()
    hashes = mixed(np.asarray(kept["key"]).astype(np.uint64))
    by_hash = np.argsort(hashes)
    values = np.asarray(kept["bits"]).astype(np.int32)
    return Model(order, tables, contexts, hashes[by_hash], values[by_hash])


class Held:
    """The sorted hashes in a task, with an index by their leading bits."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray) -> None:
        self.hashes, self.values = hashes, values
        self.shift = np.uint64(64 - max(1, (max(1, len(hashes)) - 1).bit_length()))
        leads = np.arange((1 << (64 - int(self.shift))) + 1)
        self.index = np.searchsorted(hashes >> self.shift, leads.astype(np.uint64))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 for those that are not held."""
        parts = [self._some(keys[k : k + AT_ONCE]) for k in range(0, len(keys), AT_ONCE)]
        return np.concatenate([np.zeros(0, np.int32), *parts])

    def _some(self, keys: np.ndarray) -> np.ndarray:
        hashes = mixed(keys.astype(np.uint64))
        lead = (hashes >> self.shift).astype(np.int64)
        at, stop = self.index[lead], self.index[lead + 1]
        out = np.full(len(keys), -1, np.int32)
        open_ = np.flatnonzero(at < stop)
        while len(open_):
            place = at[open_]
            hit = self.hashes[place] == hashes[open_]
            out[open_[hit]] = self.values[place[hit]]
            at[open_] += 1
            open_ = open_[~hit & (place + 1 < stop[open_])]
        return out


def scored(docs: DataFrame, model: Model, language: str | None = "lang") -> DataFrame:
    """(at, row, lang, the base statistics, length, bits, missed) of each row, `missed` not yet counted in `bits`."""
    held = docs.sparkSession.sparkContext.broadcast((model.hashes, model.values))  # HEAD n-grams at most
    others = [c for c in docs.columns if c != "text"]
    row = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    lang = F.col(language) if language in docs.columns else F.lit(None)
    inputs = docs.select(row.alias("row"), lang.cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    order = model.order
    is_symbol = np.isin(np.arange(256), np.frombuffer(SYMBOLS.encode(), np.uint8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Held(*held.value)
        for batch in slices(batches, size=TEXT_BYTES):
            text = batch.column("text")
            bounds, words = cut_words(text)
            codes = np.asarray(pc.dictionary_encode(words).indices, dtype=np.int64)
            offsets, data = joined(words, bounds)
            n_words = np.diff(bounds)
            chars = per_row((data & 0xC0) != 0x80, offsets) - np.maximum(n_words - 1, 0)
            at, keys = packed(offsets, data, order)
            found = table.find(keys)
            missed = np.flatnonzero(found < 0)
            lists = np.searchsorted(missed, at)
            columns = [
                n_words, chars, per_row(is_symbol[data], offsets), repeated_lines(text), words_repeated(codes, bounds),
                np.diff(at), per_row(np.maximum(found, 0), at),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("lang"), *[pa.array(x.astype(np.int64)) for x in columns],
                 pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array(keys[missed]))],
                names=["row", "lang", *BASE, "length", "bits", "missed"],
            )

    types = T.StructType.fromDDL(", ".join(f"{c} long" for c in (*BASE, "length", "bits")) + ", missed array<long>")
    schema = T.StructType([inputs.schema["row"], inputs.schema["lang"], *types])
    return inputs.mapInArrow(run, schema).withColumn("at", F.monotonically_increasing_id())


def backed_off(asked: DataFrame, model: Model) -> DataFrame:
    """(key, bits) of n-grams that no task holds: the longest form that the model has, and backoffs to it."""
    rest, answers = asked.select("key", F.lit(0).cast("long").alias("spent")).distinct(), []
    for k in range(model.order, 0, -1):
        shorter = F.col("key").bitwiseAND(F.lit((1 << 8 * k) - 1))
        grams = model.grams[k - 1].select(F.col("key").alias("form"), "bits")
        contexts = model.contexts[k - 1].select("context", F.col("bits").alias("back"))
        met = rest.withColumn("form", shorter).join(grams, "form", "left")
        met = met.withColumn("context", F.shiftright("form", 8)).join(contexts, "context", "left")
        met, seen = settle(met.select("key", "spent", "bits", "back"), F.count_if(F.col("bits").isNull()).alias("left"))
        answers.append(met.where("bits IS NOT NULL").select("key", (F.col("spent") + F.col("bits")).alias("bits")))
        if not seen["left"]:
            break
        rest = met.where("bits IS NULL").select("key", (F.col("spent") + F.coalesce("back", F.lit(0))).alias("spent"))
    else:
        answers.append(rest.select("key", (F.col("spent") + 8 * UNIT).alias("bits")))
    result = answers[0]
    for more in answers[1:]:
        result = result.unionByName(more)
    return result


def score(docs: DataFrame, model: Model, language: str | None = "lang") -> DataFrame:
    """As `scored`, written, with all n-grams counted and `milli`, the thousandths of a bit per n-gram."""
    rows, seen = settle(scored(docs, model, language), F.sum(F.size("missed")).alias("missed"))
    if seen["missed"]:
        missed = rows.select("at", F.explode("missed").alias("key"))
        answers = backed_off(missed.select("key"), model)
        more = missed.join(answers, "key").groupBy("at").agg(F.sum("bits").alias("more"))
        rows = rows.drop("missed").join(more, "at", "left").withColumn("bits", F.col("bits") + F.coalesce("more", F.lit(0))).drop("more")
        rows, _ = settle(rows)
    milli = F.expr(f"(1000 * bits) div ({UNIT}L * length)")
    return rows.drop("missed").withColumn("milli", F.when(F.col("length") > 0, milli))


# --- bands ----------------------------------------------------------------------------


def _alike(left: str, right: str, *keys: str) -> Column:
    same = F.lit(True)
    for key in keys:
        same &= F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return same


def _middles(values: DataFrame, *keys: str) -> DataFrame:
    """Rows and exact median of `milli` for each key, from counts of its few distinct values."""
    return values.groupBy(*keys).agg(F.sum("rows").alias("n"), F.expr("percentile(milli, 0.5, rows)").alias("middle"))


def _spreads(values: DataFrame, middles: DataFrame, around: tuple[str, ...], *keys: str) -> DataFrame:
    """Rows, and median distance from the middle of their `around`, for each key."""
    met = values.alias("v").join(middles.alias("m"), _alike("v", "m", *around))
    return met.groupBy(*[F.col(f"v.{key}") for key in keys]).agg(
        F.sum("v.rows").alias("n"), F.expr("percentile(abs(v.milli - m.middle), 0.5, v.rows)").alias("off")
    )


def bands(rows: DataFrame, width: float = WIDTH) -> DataFrame:
    """(lang, size, n, low, high): the band of each language and length class, in thousandths of a bit.

    A class of few documents lies around the middle of its language, as wide as documents of its length
    lie around the middles of theirs, or, if those are few, too, as the widest class.
    """
    values, _ = settle(rows.groupBy("lang", "size", "milli").agg(F.count(F.lit(1)).alias("rows")))
    middles, languages = _middles(values, "lang", "size"), _middles(values, "lang")
    own = _spreads(values, middles, ("lang", "size"), "lang", "size")
    sizes = _spreads(values, languages, ("lang",), "size")
    widest = sizes.agg(F.max("off").alias("off"))
    met = (
        own.alias("own").join(middles.alias("middle"), _alike("own", "middle", "lang", "size"))
        .join(languages.alias("language"), _alike("own", "language", "lang"))
        .join(sizes.alias("sizes"), _alike("own", "sizes", "size"))
        .join(widest.alias("widest"), F.lit(True))  # one row
    )
    enough, some = F.col("own.n") >= FEWEST, F.col("sizes.n") >= FEWEST
    middle = F.when(enough, F.col("middle.middle")).otherwise(F.col("language.middle"))
    off = F.when(enough, F.col("own.off")).when(some, F.col("sizes.off")).otherwise(F.col("widest.off"))
    reach = width * F.greatest(off, F.lit(float(NARROWEST)))
    return met.select("own.lang", "own.size", "own.n", (middle - reach).alias("low"), (middle + reach).alias("high"))


def judge(docs: DataFrame, language: str = "lang", model: Model | None = None, width: float = WIDTH) -> DataFrame:
    """(row, the base statistics, base_failed, perplexity, lower, upper, kept) for each row.

    `row` holds all columns but the text, whatever their names. A document fails the base rules with
    fewer than 20 words, or if over 30 % of its words lie in eight-word windows that its text repeats;
    else it is kept if its perplexity (two to the bits per byte, ends counted) lies in the band of its
    language and length class. The model is that of `docs` themselves unless one is given; the bands
    are always theirs. Null languages are one language. Null, empty and blank texts have no words, fail
    and have no perplexity; rows given twice count twice. Texts are worked on whole, in bounded batches.
    """
    rows = score(docs, model or train(docs), language)
    rows = rows.withColumn("size", F.floor(F.log2(F.greatest("length", F.lit(1)))).cast("int"))
    lookup = make_lookup(bands(rows.where("length > 0"), width), ("lang", "size"))
    placed = join_back(rows.where("length > 0"), lookup).unionByName(
        rows.where("length = 0").withColumn("low", F.lit(None).cast("double")).withColumn("high", F.lit(None).cast("double"))
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    inside = F.coalesce(F.col("milli").between(F.col("low"), F.col("high")), F.lit(False))
    return placed.select(
        "row", *BASE, failed.alias("base_failed"),
        F.pow(F.lit(2.0), F.col("bits") / F.nullif(F.lit(UNIT) * F.col("length"), F.lit(0))).alias("perplexity"),
        F.pow(F.lit(2.0), F.col("low") / 1000).alias("lower"), F.pow(F.lit(2.0), F.col("high") / 1000).alias("upper"),
        (~failed & inside).alias("kept"),
    )
