"""Vectors in tasks: reading them from Arrow, and the last step of every search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(table: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v array<double>) of vectors that are not null or empty and hold only finite numbers; null ids go."""
    v = F.col(vector).cast("array<double>")
    rows = table.select(F.col(id).cast("long").alias("id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("id").isNotNull() & (F.size("v") > 0) & finite)


def matrices(batch: pa.RecordBatch, column: str = "v") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the vectors of each length."""
    lists = batch.column(column)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        at = (ends[rows] - size)[:, None] + np.arange(size)
        yield rows, flat[at]


def nearest(found: DataFrame, k: int) -> DataFrame:
    """The k best of what tasks have found, (query_id, rank, vec_id, score); ties go to the smaller vec_id."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
