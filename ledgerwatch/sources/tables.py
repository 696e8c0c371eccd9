"""Readers and writers: text feeds, layered Parquet tables, and the fact layouts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.sources.schemas import FEED_OPTIONS, landing_schema


def read_feed(spark: SparkSession, feed: str, path: str, keyed: bool = False) -> DataFrame:
    """A delimited text feed with a header, every column as text, no inference.

    A row with too few or too many fields has its line in the column `_malformed`.
    """
    return spark.read.schema(landing_schema(feed, keyed)).options(**FEED_OPTIONS).csv(path)


def write_feed(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_lookup_layout(fact: DataFrame, path: str, files: int | None = None) -> None:
    """The fact ordered by (name_dest, step), so file and row-group bounds prune a lookup.

    txn_id is part of the range key: rows of one busy destination and hour would
    otherwise all land in a single file.
    """
    order = ["name_dest", "step", "txn_id"]
    ranged = fact.repartitionByRange(files, *order) if files else fact.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """A table in buckets of one key, sorted in each. Two such tables join bucket by bucket, without a shuffle."""
    name = f"_written_{uuid.uuid4().hex}"
    # one task for each bucket, so that a bucket is one sorted file
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").option("path", path).saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # the files stay


def read_bucketed(spark: SparkSession, path: str, schema: str, key: str, buckets: int) -> DataFrame:
    """A table that `write_bucketed` left at a path: the catalog of this session is told of its buckets."""
    name = f"_bucketed_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({schema}) USING parquet OPTIONS (path '{path}')"
        f" CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS"
    )
    return spark.table(name)


# what the interleaved layout serves: equality on accounts and ids, ranges of hours
BLOOM = ("name_dest", "name_orig", "txn_id")
CELL_BITS = 8  # of each column in the interleaved order


def _interleaved(columns: list[Column]) -> Column:
    """One number whose bits are those of the columns in turn; each has CELL_BITS of them."""
    z = F.lit(0)
    for bit in range(CELL_BITS):
        for place, column in enumerate(columns):
            taken = F.shiftright(column, bit).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(taken, bit * len(columns) + len(columns) - 1 - place))
    return z


def write_interleaved_layout(
    fact: DataFrame, path: str, last_step: int = 744, files: int | None = None, row_group: int = 32 << 20, distinct: int = 1 << 17
) -> None:
    """The fact along a curve through (name_dest, step, name_orig), with Bloom filters on accounts and ids.

    A row group holds accounts of neighbouring hashes and neighbouring hours, so a lookup by either
    account, with or without hours, leaves out most row groups by their filters and bounds. Equal
    cells are split by txn_id, so a busy account is dealt over several files. `distinct` sizes the
    filters: the values of a column that a row group holds.
    """
    cells = 1 << CELL_BITS
    hashes = [F.pmod(F.xxhash64(c), F.lit(cells)).cast("int") for c in ("name_dest", "name_orig")]
    hour = F.least(F.greatest(F.coalesce("step", F.lit(0)), F.lit(0)) * cells / (last_step + 1), F.lit(cells - 1)).cast("int")
    order = ["_cell", "name_dest", "step", "txn_id"]
    placed = fact.withColumn("_cell", _interleaved([hashes[0], hour, hashes[1]]))
    ranged = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    writer = ranged.sortWithinPartitions(*order).drop("_cell").write.mode("overwrite").option("parquet.block.size", row_group)
    for column in BLOOM:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", distinct)
    writer.parquet(path)


def rows_scanned(df: DataFrame) -> int:
    """Run a frame that reads one table, and return how many rows its scan let through from files and row groups."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def party_rows(fact: DataFrame, side: str, account: str, first_step: int | None = None, last_step: int | None = None) -> DataFrame:
    """Transactions of one account as `name_orig` or `name_dest`, over a range of hours if one is given."""
    rows = fact.where(F.col(side) == account)
    return rows if first_step is None else rows.where(F.col("step").between(first_step, last_step))


def destination_counts(fact: DataFrame, name_dest: str, first_step: int, last_step: int) -> DataFrame:
    """Transactions into one destination over a step range, by type."""
    hit = (F.col("name_dest") == name_dest) & F.col("step").between(first_step, last_step)
    return fact.where(hit).groupBy("type").agg(F.count(F.lit(1)).alias("txn_count"))


def fraud_rows(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("is_fraud") == 1)


def open_rows(exceptions: DataFrame) -> DataFrame:
    return exceptions.where(F.col("status") == "OPEN")
