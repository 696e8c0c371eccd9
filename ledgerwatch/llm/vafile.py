"""Exact top-k inner products through vector-approximation files.

Vectors are packed into blocks, each with a coarse cell for every component. A task scans the cells
of a block for a block of queries: since a cell has a fixed width, one matrix product gives a lower
and an upper bound of every score. Exact vectors are then read in the order of their upper bounds,
until the next bound is below the kth score found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import slices
from ledgerwatch.llm.vectors import matrices, nearest, usable
from ledgerwatch.session import settle

BLOCK = 4096  # vectors in a block
QUERIES = 1024  # queries in a block, about
CELLS = 64  # along each component
STEP = 64  # exact vectors read at once
SCALE = 256

BLOCKS = "size int, ids binary, cells binary, low binary, width binary, exact binary"


def scaled(v: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as integers; components must stay under 2^53 and scores under 2^63."""
    return np.floor(v * scale).astype(np.int64)


def build(table: DataFrame) -> DataFrame:
    """The approximation file: one row for each block of vectors of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BLOCK):
            ids = batch.column("id").to_numpy()
            for rows, v in matrices(batch):
                exact = scaled(v)
                low, high = exact.min(0), exact.max(0)
                width = np.maximum((high - low + 1) / CELLS, 1e-9)
                cells = np.clip((exact - low) / width, 0, CELLS - 1).astype(np.uint8)
                row = {
                    "size": exact.shape[1], "ids": ids[rows].tobytes(), "cells": cells.tobytes(),
                    "low": low.astype(float).tobytes(), "width": width.tobytes(), "exact": exact.tobytes(),
                }
                yield pa.RecordBatch.from_pylist([row], schema=_BLOCK_SCHEMA)

    return table.mapInArrow(run, BLOCKS)


_BLOCK_SCHEMA = pa.schema(
    [("size", pa.int32()), *[(name, pa.binary()) for name in ("ids", "cells", "low", "width", "exact")]]
)


def search_block(queries: np.ndarray, own: np.ndarray, ids: np.ndarray, cells: np.ndarray, low: np.ndarray,
                 width: np.ndarray, exact: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Query row, vec_id and score of the k best of a block for each query, and how many exact vectors were read."""
    q = queries.astype(float)
    middle = low + (cells + 0.5) * width
    near = q @ middle.T
    spread = np.abs(q) @ width / 2
    slack = 1e-9 * (np.abs(q) @ np.abs(middle).max(0) + 1)  # rounding of the bounds themselves
    upper, lower = near + (spread + slack)[:, None], near - (spread + slack)[:, None]
    itself = own[:, None] == ids[None, :]
    upper[itself], lower[itself] = -np.inf, -np.inf
    held = min(k, len(ids))
    floor = np.partition(lower, len(ids) - held, axis=1)[:, len(ids) - held]
    rows, found, scores, read = [], [], [], 0
    for r in range(len(q)):
        order = np.flatnonzero((upper[r] >= floor[r]) & ~itself[r])
        order = order[np.argsort(-upper[r, order], kind="stable")]
        best_id, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for start in range(0, len(order), STEP):
            some = order[start : start + STEP]
            if len(best) == k and upper[r, some[0]] < best[-1]:
                break
            read += len(some)
            best = np.concatenate([best, exact[some] @ queries[r]])
            best_id = np.concatenate([best_id, ids[some]])
            top = np.lexsort((best_id, -best))[:k]
            best, best_id = best[top], best_id[top]
        rows.append(np.full(len(best), r))
        found.append(best_id)
        scores.append(best)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *rows]), np.concatenate([none, *found]), np.concatenate([none, *scores]), read


def top_k(table: DataFrame, is_query: Column, k: int = 5, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products of every query, ties to the smaller id.

    `is_query` picks the queries among the rows by their id. All rows but those with the query's id
    are candidates; a row given twice is one candidate, a query given twice is asked once, by its
    least vector. Vectors that are null, empty or hold null or non-finite components take no part,
    and vectors of another length than the query are no candidates. Without vectors there is no row.
    """
    rows = usable(table, id, vector)
    blocks, seen = settle(build(rows))
    asked = table.where(is_query)
    asked = usable(asked, id, vector).groupBy("id").agg(F.min("v").alias("v"))
    asked, counted = settle(asked)
    if not seen["rows"] or not counted["rows"]:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    packs = max(1, -(-counted["rows"] // QUERIES))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, QUERIES):
            ids, pack = batch.column("id").to_numpy(), batch.column("pack").to_numpy()
            for at, v in matrices(batch):
                for p in np.unique(pack[at]):
                    own = pack[at] == p
                    row = {"q_size": v.shape[1], "pack": int(p), "q_ids": ids[at[own]].tobytes(), "q": scaled(v[own]).tobytes()}
                    yield pa.RecordBatch.from_pylist(
                        [row], schema=pa.schema([("q_size", pa.int32()), ("pack", pa.int32()), ("q_ids", pa.binary()), ("q", pa.binary())])
                    )

    pack = F.pmod(F.xxhash64("id"), F.lit(packs)).cast("int")
    queries = asked.withColumn("pack", pack).repartition("pack").mapInArrow(packed, "q_size int, pack int, q_ids binary, q binary")
    # every block meets every pack of queries
    pairs = blocks.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1)))).join(
        queries, "pack"
    ).where("size = q_size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                size = row["size"]
                own = np.frombuffer(row["q_ids"], np.int64)
                which, found, scores, _ = search_block(
                    np.frombuffer(row["q"], np.int64).reshape(-1, size), own, np.frombuffer(row["ids"], np.int64),
                    np.frombuffer(row["cells"], np.uint8).reshape(-1, size), np.frombuffer(row["low"]),
                    np.frombuffer(row["width"]), np.frombuffer(row["exact"], np.int64).reshape(-1, size), k,
                )
                yield pa.RecordBatch.from_arrays([pa.array(own[which]), pa.array(found), pa.array(scores)], names=["query_id", "vec_id", "score"])

    return nearest(pairs.mapInArrow(run, "query_id long, vec_id long, score long"), k)
