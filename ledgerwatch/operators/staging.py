"""Text feeds to typed staging tables, and row ids for feeds that have none."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.functions.expressions import typed
from ledgerwatch.sources.schemas import FEEDS, MALFORMED, TRANSACTION_COLUMNS

ROWS_PER_GROUP = 50_000  # distinct rows that one task orders, about
COPIES_PER_ROW = 100_000


def stage(raw: DataFrame, feed: str) -> DataFrame:
    """Typed columns of a feed; a txn_id the source brings itself is kept.

    A row that the reader could not cut into the feed's columns fails the job.
    """
    columns = list(FEEDS[feed])
    if feed == "transactions" and "txn_id" in raw.columns:
        columns.insert(0, ("txn_id", "bigint"))
    if MALFORMED in raw.columns:
        bad = F.concat(F.lit(f"malformed row in {feed}: "), F.col(MALFORMED))
        first = columns[0][0]
        # checked where the first column is read, which every use of the stage keeps
        checked = F.when(F.col(MALFORMED).isNull(), F.col(first)).otherwise(F.raise_error(bad))
        raw = raw.withColumn(first, checked)
    return raw.select(*[typed(name, sql_type) for name, sql_type in columns])


def stage_transactions(raw: DataFrame) -> DataFrame:
    staged = stage(raw, "transactions")
    if "txn_id" in staged.columns:
        return staged
    return with_row_ids(staged, [name for name, _ in TRANSACTION_COLUMNS])


def stage_with_rejects(raw: DataFrame, feed: str) -> tuple[DataFrame, DataFrame]:
    """As `stage`, but a row with text that does not parse, or with too few or too many
    fields, goes to a reject frame as it came."""
    columns = list(FEEDS[feed])
    if feed == "transactions" and "txn_id" in raw.columns:
        columns.insert(0, ("txn_id", "bigint"))
    bad = F.col(MALFORMED).isNotNull() if MALFORMED in raw.columns else F.lit(False)
    for name, sql_type in columns:
        given = F.nullif(F.col(name), F.lit("")).isNotNull()
        bad = bad | (given & typed(name, sql_type, tolerant=True).isNull())
    good = raw.where(~bad).select(*[typed(name, t, tolerant=True) for name, t in columns])
    return good, raw.where(bad)


def with_row_ids(df: DataFrame, columns: list[str], name: str = "txn_id") -> DataFrame:
    """Dense ids 1..n over a total order of the rows, whatever the partitioning.

    The order is that of an md5 of the row, then the row itself. Digest prefixes
    spread distinct rows evenly; equal rows are counted first, so a row repeated
    any number of times is one row until its copies are written out again. The prefix grows
    with the table, so a group has a bounded size; groups are offset in two levels, each of
    which one task can order.
    """
    digits = max(2, math.ceil(math.log(max(2, df.count()) / ROWS_PER_GROUP, 16)))
    upper = (digits + 1) // 2
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    digest = F.md5(text)
    kinds = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    kinds = kinds.withColumn("_digest", digest).withColumn(
        "_group", F.substring("_digest", 1, digits)
    )
    totals = kinds.groupBy("_group").agg(F.sum("_copies").alias("_total"))
    totals = totals.withColumn("_upper", F.substring("_group", 1, upper))
    earlier = (Window.unboundedPreceding, -1)
    # the upper level has the square root of the number of groups
    tops = totals.groupBy("_upper").agg(F.sum("_total").alias("_sum"))
    top_offsets = tops.select(
        "_upper",
        F.coalesce(F.sum("_sum").over(Window.orderBy("_upper").rowsBetween(*earlier)), F.lit(0)).alias("_base"),
    )
    inside = Window.partitionBy("_upper").orderBy("_group").rowsBetween(*earlier)
    offsets = (
        totals.withColumn("_inner", F.coalesce(F.sum("_total").over(inside), F.lit(0)))
        .join(F.broadcast(top_offsets), "_upper")
        .select("_group", (F.col("_base") + F.col("_inner")).alias("_offset"))
    )
    within = (
        Window.partitionBy("_group")
        .orderBy("_digest", *[F.col(c).asc_nulls_first() for c in columns])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = kinds.withColumn("_before", F.coalesce(F.sum("_copies").over(within), F.lit(0))).join(
        offsets, "_group"
    )
    first = F.col("_offset") + F.col("_before") + 1
    last = F.col("_offset") + F.col("_before") + F.col("_copies")
    placed = placed.select(*columns, "_copies", first.alias("_first"), last.alias("_last"))
    few = placed.where(F.col("_copies") <= COPIES_PER_ROW).select(
        F.explode(F.sequence("_first", "_last")).alias(name), *columns
    )
    # the copies of a busy row are cut into runs, and the runs dealt out to tasks
    step = F.lit(COPIES_PER_ROW).cast("bigint")
    runs = (
        placed.where(F.col("_copies") > COPIES_PER_ROW)
        .withColumn("_start", F.explode(F.sequence("_first", "_last", step)))
        .repartition(F.col("_start"))
    )
    stop = F.least(F.col("_start") + step - 1, F.col("_last"))
    many = runs.select(F.explode(F.sequence(F.col("_start"), stop)).alias(name), *columns)
    return few.unionByName(many)
