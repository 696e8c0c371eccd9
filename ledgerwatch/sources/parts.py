"""Parquet tables in parts: a writer names the parts it adds to or replaces, a reader those it wants."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Parts:
    """A table at a path, split by its last columns, `by`; `columns` declares all of them.

    Rows are added by appending files to the parts they belong to. Tables whose rows are partial
    aggregates are folded by their readers, so nothing is rewritten when rows come in.
    """

    spark: SparkSession
    path: str
    columns: str
    by: tuple[str, ...] = ("part",)

    def create(self) -> Parts:
        """The table, made without rows if there is none at its path."""
        empty = self.spark.createDataFrame([], self.columns)
        empty.write.mode("ignore").partitionBy(*self.by).parquet(self.path)
        return self

    def _shaped(self, rows: DataFrame) -> DataFrame:
        names = self.spark.createDataFrame([], self.columns).schema
        shaped = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in names])
        # few files a part, and a part that holds most rows is written by several tasks
        return shaped.hint("rebalance", *self.by)

    def append(self, rows: DataFrame) -> None:
        self._shaped(rows).write.mode("append").partitionBy(*self.by).parquet(self.path)

    def replace(self, rows: DataFrame) -> None:
        """Write the parts that `rows` has anew and leave all others as they are.

        `rows` must not read this table: settle them first.
        """
        writer = self._shaped(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*self.by).parquet(self.path)

    def read(self, parts: Iterable | None = None) -> DataFrame:
        """All rows, or those of some values of the first column of `by`: files of others are not opened."""
        rows = self.spark.read.schema(self.columns).parquet(self.path)
        return rows if parts is None else rows.where(F.col(self.by[0]).isin(*parts) if (parts := list(parts)) else F.lit(False))


def values(rows: DataFrame, column: str) -> list:
    """The distinct values of a part column: parts are coarse, so there are few."""
    return [r[0] for r in rows.select(column).distinct().collect()]
