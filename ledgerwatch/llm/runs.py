"""Periodic runs of words, found by the branching-tandem test on an enhanced suffix array.

All texts of a batch share one suffix array, built by prefix doubling over (text, word) pairs, so no
two texts ever meet in it. The intervals of its LCP array are found by nearest smaller values, not as
a tree. In every interval of depth d, each suffix i outside the largest child asks the inverse array
whether i + d or i - d lies in the interval, but in another child: then a square with period d ends
where it cannot be moved to the right. Moving it to the left as far as it goes gives the run; squares
of several periods with the same run are merged into the smallest one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.llm.common import cut_words, slices

SHORTEST = 12  # words in a run, at least; and two periods
EXPANDED = 1 << 21  # suffixes of small children held at once

RUNS = "array<struct<start: long, length: long, period: long>>"


def doubled(first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and ranks by the first 1, 2, 4, ... symbols, until all are apart.

    `first` holds the symbols, which also tell the texts apart; `stop` is the end of each position's
    text. Two positions have the same rank at level k exactly if their next 2^k symbols exist and are
    equal. Only suffixes that are still tied are sorted again.
    """
    n = len(first)
    order = np.argsort(first, kind="stable")
    heads = np.ones(n, bool)
    heads[1:] = first[order[1:]] != first[order[:-1]]
    at = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(heads, at, 0))
    levels, step = [rank], 1
    while True:
        tied = np.flatnonzero(~(heads & np.append(heads[1:], True)))
        if not len(tied):
            return order, levels
        suffix = order[tied]
        next_ = suffix + step
        inside = next_ < stop[suffix]
        key = rank[suffix] * (n + 1) + np.where(inside, rank[np.minimum(next_, n - 1)] + 1, 0)
        by_key = np.argsort(key, kind="stable")
        key, suffix = key[by_key], suffix[by_key]
        order[tied] = suffix
        new = np.ones(len(tied), bool)
        new[1:] = key[1:] != key[:-1]
        heads[tied] = new
        rank = rank.copy()
        rank[suffix] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        levels.append(rank)
        step *= 2


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """How many symbols each suffix shares with the one before it in the array (0 for the first)."""
    n = len(order)
    out = np.zeros(n, np.int64)
    met = 1 + np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]])
    a, b = order[met - 1].copy(), order[met].copy()
    for k in range(len(levels) - 1, -1, -1):
        inside = np.maximum(a, b) < n
        same = inside & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
        a += same << k
        b += same << k
    out[met] = a - order[met - 1]
    return out


def smaller_around(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of `at`, the nearest places before and after it with a smaller value.

    The first value is below all others asked for; after the last one there is a place of its own.
    """
    n, depth = len(values), values[at]
    least, width = [values], 1
    while 2 * width <= n:
        last = least[-1]
        least.append(np.minimum(last[:-width], last[width:]))
        width *= 2
        if not least[-1].any():  # no stretch is so long
            break
    after, before = at + 1, at - 1
    for k in range(len(least) - 1, -1, -1):
        size, table = 1 << k, least[k]
        fits = after + size <= n
        after = after + np.where(fits & (table[np.minimum(after, len(table) - 1)] >= depth), size, 0)
        begin = before - size + 1
        fits = begin >= 0
        before = before - np.where(fits & (table[np.maximum(begin, 0)] >= depth), size, 0)
    return before, after


def branching_squares(order: np.ndarray, inverse: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and period of the squares that cannot be moved to the right."""
    n, none = len(order), np.zeros(0, np.int64)
    cut = np.flatnonzero(shared > 0)
    if not len(cut):
        return none, none
    low, high = smaller_around(shared, cut)  # the interval of a cut is low .. high - 1
    by_interval = np.argsort(low * (n + 1) + high, kind="stable")
    cut, low, high = cut[by_interval], low[by_interval], high[by_interval]
    first = np.ones(len(cut), bool)
    first[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    begin = np.flatnonzero(first)  # an interval with m cuts has m + 1 children
    number = np.cumsum(first) - 1
    size = len(cut) + len(begin)
    lead = begin + np.arange(len(begin))  # the place of each interval's first child
    start, owner = np.empty(size, np.int64), np.empty(size, np.int64)
    rest = np.arange(len(cut)) + number + 1
    start[lead], start[rest] = low[begin], cut
    owner[lead], owner[rest] = begin, begin[number]
    end = np.append(start[1:], 0)
    last = np.append(lead[1:], size) - 1
    end[last] = high[begin]
    length = end - start
    # the first of the largest children is left out
    largest = np.maximum.reduceat(length, lead)
    is_largest = length == np.repeat(largest, np.diff(np.append(lead, size)))
    seen = np.cumsum(is_largest)
    is_largest &= seen - np.repeat(seen[lead] - is_largest[lead], np.diff(np.append(lead, size))) == 1
    small = np.flatnonzero(~is_largest)
    starts, periods = [none], [none]
    bounds = np.cumsum(length[small])
    at = 0
    while at < len(small):  # some children at a time
        done = bounds[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(bounds, done + EXPANDED)))
        some = small[at:upto]
        at = upto
        count = length[some]
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        suffix = order[np.repeat(start[some], count) + inner]
        own = np.repeat(owner[some], count)
        child = np.repeat(start[some], count), np.repeat(end[some], count)
        depth = shared[cut[own]]
        for other, found in ((suffix + depth, suffix), (suffix - depth, suffix - depth)):
            inside = (other >= 0) & (other < n)
            place = inverse[np.clip(other, 0, n - 1)]
            inside &= (place >= low[own]) & (place < high[own]) & ((place < child[0]) | (place >= child[1]))
            starts.append(found[inside])
            periods.append(depth[inside])
    return np.concatenate(starts), np.concatenate(periods)


def runs_of(codes: np.ndarray, bounds: np.ndarray, shortest: int = SHORTEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of all runs, by start and then period.

    Text r is codes[bounds[r]:bounds[r + 1]]. A run is as long as its period allows, has two periods
    at least and `shortest` words.
    """
    n, none = len(codes), np.zeros(0, np.int64)
    if not n:
        return none, none, none
    counts = np.diff(bounds)
    text = np.repeat(np.arange(len(counts)), counts)
    begin, stop = bounds[:-1][text], bounds[1:][text]
    order, levels = doubled(text * (int(codes.max()) + 1) + codes, stop)
    square, period = branching_squares(order, levels[-1], common_prefixes(order, levels))
    end, head = square + 2 * period, square.copy()
    for k in range(len(levels) - 1, -1, -1):  # to the left in powers of two
        back = head - (1 << k)
        inside = back >= begin[square]
        back = np.maximum(back, 0)
        same = inside & (levels[k][back] == levels[k][np.minimum(back + period, n - 1)])
        head = np.where(same, back, head)
    long = end - head >= shortest
    head, end, period = head[long], end[long], period[long]
    by_run = np.lexsort((period, end, head))
    head, end, period = head[by_run], end[by_run], period[by_run]
    new = np.ones(len(head), bool)
    new[1:] = (head[1:] != head[:-1]) | (end[1:] != end[:-1])
    head, end, period = head[new], end[new], period[new]
    by_start = np.lexsort((period, head))
    return head[by_start], end[by_start], period[by_start]


def without_repeats(n: int, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of n words stay: all but those that a run holds after its first period."""
    covers = np.zeros(n + 1, np.int64)
    np.add.at(covers, start + period, 1)
    np.add.at(covers, end, -1)
    return np.cumsum(covers)[:n] == 0


def _lists(values: pa.Array, bounds: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), values)


def find(
    docs: DataFrame,
    retell: Callable[[pa.StructArray, np.ndarray], np.ndarray] | None = None,
    shortest: int = SHORTEST,
) -> DataFrame:
    """(row, n_words, runs, text): the periodic runs of each text, and the text without their repeats.

    `row` holds all columns but the text, whatever their names. Words are cut at ASCII white space and
    numbered from 0; `runs` has start, length and smallest period of each run, by start and period.
    The text has its kept words, joined by one space. A null text has no words, no runs and stays null;
    an empty or blank one has none and becomes empty. Rows given twice are worked on twice. A text is
    worked on whole; memory is in proportion to the longest one.

    `retell`, if given, is handed the rows of a batch and the bounds of their words, and gives the
    number of the word that shall stand in each place, before anything is searched.
    """
    others = [c for c in docs.columns if c != "text"]
    row = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    inputs = docs.select(row.alias("row"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bounds, words = cut_words(batch.column("text"))
            coded = pc.dictionary_encode(words)
            codes = np.asarray(coded.indices).astype(np.int64)
            if retell is not None:
                codes = codes[retell(batch.column("row"), bounds)]
            start, end, period = runs_of(codes, bounds, shortest)
            stays = without_repeats(len(codes), start, end, period)
            left = np.concatenate([[0], np.cumsum(stays)])[bounds]
            kept = coded.dictionary.take(pa.array(codes[stays]))
            text = pc.binary_join(_lists(kept, left), pa.scalar(" ", kept.type))
            blank = batch.column("text").is_null()
            text = pc.if_else(blank, pa.scalar(None, text.type), text).cast(pa.string())
            which = np.searchsorted(bounds, start, side="right") - 1
            found = pa.StructArray.from_arrays(
                [pa.array(start - bounds[which]), pa.array(end - start), pa.array(period)], names=["start", "length", "period"]
            )
            held = np.searchsorted(which, np.arange(batch.num_rows + 1))
            runs = pa.ListArray.from_arrays(pa.array(held, pa.int32()), found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.diff(bounds)), runs, text], names=["row", "n_words", "runs", "text"]
            )

    schema = T.StructType([inputs.schema["row"], *T.StructType.fromDDL(f"n_words long, runs {RUNS}, text string")])
    return inputs.mapInArrow(run, schema)
