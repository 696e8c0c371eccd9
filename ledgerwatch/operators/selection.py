"""Exact order statistics of a large column in two scans.

A sort or Spark's exact `percentile` would bring all distinct values together in one task. Here a
mergeable quantile sketch brackets the wanted rank within a fraction of the rows. A second scan counts
what lies below the bracket and folds the values inside it, by value, into a small table. Only that
table is read again: it is narrowed by counting equal bins, until the rank is an end of its bin.
"""

from __future__ import annotations

import bisect
import itertools
import math

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgerwatch.session import settle

BINS = 4096
SKETCH = 4096  # its ranks are off by 0.13 % at most, with a chance of 99 in 100
MARGIN = 0.004  # share of the rows that the bracket holds to each side


def _narrowed(values: DataFrame, whole: bool, k: int) -> float | int:
    """The value of rank k (from 0) of a table of distinct values with their `rows`."""
    value = F.col("value")
    low, high, count = values.agg(F.min(value), F.max(value), F.sum("rows")).first()
    while True:
        if k == 0 or low == high:
            return low
        if k == count - 1:
            return high
        part = values.where(value.between(F.lit(low), F.lit(high)))
        if whole:
            width = (high - low) // BINS + 1
            bin_no = F.expr(f"(value - {low}L) div {width}L")
        else:
            width = high / BINS - low / BINS
            if width == 0:
                width = math.ulp(high)
            bin_no = F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(BINS - 1))
        bins = (
            part.groupBy(bin_no.alias("bin"))
            .agg(F.sum("rows").alias("rows"), F.min(value).alias("low"), F.max(value).alias("high"))
            .orderBy("bin")
            .collect()  # at most BINS rows
        )
        for found in bins:
            if k < found["rows"]:
                break
            k -= found["rows"]
        count, low, high = found["rows"], found["low"], found["high"]


def at_ranks(df: DataFrame, column: str, position) -> list[float | int]:
    """The values of some neighbouring ranks (from 0) among the non-NULL values of a double or integer column.

    `position` gives the ranks in order, from the number of values.
    """
    whole = dict(df.dtypes)[column] in ("bigint", "int", "smallint", "tinyint")
    kind = "bigint" if whole else "double"
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast(kind).alias("value"))
    sketch = getattr(F, f"kll_sketch_agg_{kind}")("value", SKETCH)
    count, low, high, held = values.agg(F.count("value"), F.min("value"), F.max("value"), sketch).first()
    ranks = position(count)
    if not ranks or not 0 <= ranks[0] <= ranks[-1] < count:
        raise ValueError(f"rank {ranks} of {count} rows")
    near = getattr(F, f"kll_sketch_get_quantile_{kind}")
    first, last = ranks[0] / count - MARGIN, (ranks[-1] + 1) / count + MARGIN
    ends = df.sparkSession.range(1).select(near(F.lit(bytes(held)), F.lit(max(first, 0.0))), near(F.lit(bytes(held)), F.lit(min(last, 1.0)))).first()
    low, high = ends[0] if first > 0 else low, ends[1] if last < 1 else high

    below = Observation()
    seen = values.observe(below, F.count_if(F.col("value") < F.lit(low)).alias("rows"))
    inside = seen.where(F.col("value").between(F.lit(low), F.lit(high)))
    folded, size = settle(inside.groupBy("value").agg(F.count(F.lit(1)).alias("rows")), F.sum("rows").alias("all"))
    skipped = below.get["rows"]
    if not skipped <= ranks[0] or not ranks[-1] < skipped + (size["all"] or 0):
        # the sketch was off by more than its bound: fold all values
        folded, size = settle(values.groupBy("value").agg(F.count(F.lit(1)).alias("rows")))
        skipped = 0
    if size["rows"] <= BINS:  # as few as a round of bins
        found = sorted(tuple(r) for r in folded.select("value", "rows").collect())
        upto = list(itertools.accumulate(rows for _, rows in found))
        return [found[bisect.bisect_right(upto, k - skipped)][0] for k in ranks]
    return [_narrowed(folded, whole, k - skipped) for k in ranks]


def kth_smallest(df: DataFrame, column: str, k: int) -> float | int:
    """The value of rank k (from 0) among the non-NULL values of a double or integer column."""
    return at_ranks(df, column, lambda count: [k])[0]


def quantile(df: DataFrame, column: str, q: float) -> float:
    """The q-quantile with linear interpolation between neighbouring ranks."""
    part = 0.0

    def ranks(count: int) -> list[int]:
        nonlocal part
        if count == 0:
            raise ValueError("no values")
        rank = math.floor((count - 1) * q)
        part = (count - 1) * q - rank
        return [rank, rank + 1] if part else [rank]

    below, *above = map(float, at_ranks(df, column, ranks))
    return below + (above[0] - below) * part if above else below
