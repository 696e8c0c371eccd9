"""Approximate nearest neighbours by cosine through shifted space-filling curves.

Unit vectors are projected to a few axes in several ways, spread evenly over a cube, shifted, and
laid out along a Hilbert curve; Spark sorts each order by ranges. A query is compared exactly with
all rows within a window of its place in each order. Orders are cut into blocks of fixed size, and a
query is sent to the blocks that its window reaches, so no task holds more than a block.

The window is fitted: a bounded sample of queries is answered by brute force, and the window is the
least that finds the wanted share of the true neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.llm import hilbert
from ledgerwatch.llm.common import slices
from ledgerwatch.llm.vectors import matrices, nearest, usable
from ledgerwatch.session import settle

ORDERS, AXES, BITS = 32, 16, 3
BLOCK = 4096  # rows of an order in a task
LEAST_WINDOW = 64
SAMPLE = 96  # queries answered by brute force to fit the window
RECALL = 0.96  # share of their true neighbours that the window must reach

ROWS = "ord int, key long, id long, query boolean, ids binary, v binary"
_SCHEMA = pa.schema([("ord", pa.int32()), ("key", pa.int64()), ("id", pa.int64()), ("query", pa.bool_()), ("ids", pa.binary()), ("v", pa.binary())])


def place(v: np.ndarray, order: int) -> np.ndarray:
    """Hilbert keys of vectors in one order. Orders differ by projection and shift."""
    size = v.shape[1]
    rng = np.random.default_rng([size, order])
    axes = min(AXES, size)
    basis = np.linalg.qr(rng.normal(size=(size, axes)))[0]
    unit = v / np.sqrt((v * v).sum(1))[:, None]
    # projections of unit vectors have a deviation of about 1 / sqrt(size); a logistic curve spreads them
    spread = 1 / (1 + np.exp(-1.702 * sqrt(size) * (unit @ basis)))
    return hilbert.keys((spread + rng.random(axes)) / 2, BITS)


def laid_out(rows: DataFrame, orders: int) -> DataFrame:
    """Rows (id, query, ids array<long>, v) once for each order, with their key; vectors as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, query, own = batch.column("id"), batch.column("query"), batch.column("ids").to_pylist()
            own = pa.array([np.array(x or [], np.int64).tobytes() for x in own], pa.binary())
            for at, v in matrices(batch):
                raw = pa.array([x.tobytes() for x in v], pa.binary())
                take = pa.array(at)
                for order in range(orders):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), order, np.int32)), pa.array(place(v, order)), ids.take(take), query.take(take), own.take(take), raw],
                        schema=_SCHEMA,
                    )

    return rows.mapInArrow(run, ROWS)


def ranked(rows: DataFrame) -> DataFrame:
    """The rows sorted by order and key, with their rank over all orders, as a written table."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            places = pa.array(np.arange(at, at + batch.num_rows))
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, part, np.int32)), places], names=[*_SCHEMA.names, "part", "at"]
            )

    keys = ["ord", "key", "id", "query"]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    table, _ = settle(ordered.mapInArrow(numbered, ROWS + ", part int, at long"))
    # one row for each partition of the sort
    sizes = table.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return table.join(F.broadcast(starts), "part").withColumn("rank", F.col("start") + F.col("at")).drop("part", "at", "start")


def best_of(q: np.ndarray, own: int, v: np.ndarray, ids: list[np.ndarray], k: int) -> tuple[list[int], list[float]]:
    """The k best (id, cosine) among vectors that each stand for some ids; all in double precision."""
    near = v @ q
    norms = np.sqrt((v * v).sum(1)) * sqrt(float((q * q).sum()))
    near = near / norms
    held = min(k + 1, len(near))
    floor = np.partition(near, len(near) - held)[len(near) - held] - 1e-9
    kept = np.flatnonzero(near >= floor)
    score = (v[kept] * q).sum(1) / norms[kept]  # row by row, so equal vectors have equal scores
    pairs = sorted((-s, int(i)) for s, j in zip(score.tolist(), kept) for i in ids[j] if i != own)[:k]
    return [i for _, i in pairs], [-s for s, _ in pairs]


FOUND = "query_id long, vec_id long, score double"


def _found(rows: list[tuple[int, list[int], list[float]]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([q for q, ids, _ in rows for _ in ids], pa.int64()), pa.array([i for _, ids, _ in rows for i in ids], pa.int64()),
         pa.array([s for _, _, scores in rows for s in scores], pa.float64())], names=["query_id", "vec_id", "score"],
    )


def brute(candidates: DataFrame, queries: list[tuple[int, np.ndarray]], k: int) -> DataFrame:
    """True neighbours of a few queries (at most SAMPLE), from one scan."""
    held = candidates.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids = batch.column("ids").to_pylist()
            for at, v in matrices(batch):
                own = [np.array(ids[j]) for j in at]
                yield _found([(qid, *best_of(q, qid, v, own, k)) for qid, q in held.value if len(q) == v.shape[1]])

    return nearest(candidates.mapInArrow(run, FOUND), k)


def fitted_window(table: DataFrame, candidates: DataFrame, queries: DataFrame, k: int) -> int:
    """The least window in which RECALL of the sampled queries' true neighbours are, in some order."""
    sample = queries.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    if not sample:
        return LEAST_WINDOW
    true = brute(candidates, [(r.id, np.array(r.v)) for r in sample], k).select("query_id", "vec_id").collect()
    wanted = {r.id for r in sample} | {r.vec_id for r in true}
    # at most SAMPLE * (k + 1) ids, in each order
    first = F.expr("array_min(ids)")
    names = candidates.select(F.explode("ids").alias("id"), first.alias("stands")).where(F.col("id").isin(list(wanted)))
    stands = {r.id: r.stands for r in names.collect()}
    spots = table.where(F.col("id").isin([*wanted, *stands.values()])).select("ord", "id", "query", "rank").collect()
    at_query = {(r.ord, r.id): r.rank for r in spots if r.query}
    at_vector = {(r.ord, r.id): r.rank for r in spots if not r.query}
    orders = {r.ord for r in spots}
    gaps = sorted(
        min(abs(at_query[o, r.query_id] - at_vector[o, stands[r.vec_id]]) for o in orders) for r in true
    )
    return max(LEAST_WINDOW, gaps[min(len(gaps) - 1, int(RECALL * len(gaps)))]) if gaps else LEAST_WINDOW


def neighbours(
    table: DataFrame, is_query: Column, k: int = 5, orders: int = ORDERS, id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every query by cosine, ties to the smaller id.

    `is_query` picks the queries among the rows by their id. All rows but those with the query's id
    are candidates, and each is indexed. Of equal vectors the k + 1 smallest ids are kept, as others
    can be in no result. Vectors that are null, empty, zero or hold null or non-finite components
    take no part; vectors of another length are no candidates. A query given twice is asked once, by
    its least vector. Without vectors there is no row.
    """
    nonzero = F.exists("v", lambda x: x != 0)
    rows = usable(table, id, vector).where(nonzero)
    # a rank limit within equal vectors is applied before the shuffle, too
    copies = Window.partitionBy("v").orderBy("id")
    candidates = (
        rows.distinct().withColumn("_n", F.row_number().over(copies)).where(F.col("_n") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )
    candidates, seen = settle(candidates.select("ids", "v"))
    queries = usable(table.where(is_query), id, vector).where(nonzero).groupBy("id").agg(F.min("v").alias("v"))
    queries, asked = settle(queries)
    if not seen["rows"] or not asked["rows"]:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    both = candidates.select(F.expr("ids[0]").alias("id"), F.lit(False).alias("query"), "ids", "v").unionByName(
        queries.select("id", F.lit(True).alias("query"), F.array().cast("array<long>").alias("ids"), "v")
    )
    order = ranked(laid_out(both, orders))
    window = fitted_window(order, candidates, queries, k)
    # a query goes to every block that its window reaches
    first, last = (F.floor((F.col("rank") + F.lit(d)) / BLOCK) for d in (-window, window))
    reached = order.where("query").withColumn("block", F.explode(F.sequence(F.greatest(first, F.lit(0).cast("long")), last)))
    placed = order.where("NOT query").withColumn("block", F.floor(F.col("rank") / BLOCK)).unionByName(reached)

    def search(key: tuple, group: pa.Table) -> pa.Table:
        table = group.combine_chunks().sort_by("rank")
        asked = table.filter(table["query"])
        held = table.filter(pc.invert(table["query"]))
        ranks, ords = held["rank"].to_numpy(), held["ord"].to_numpy()
        raw, ids = held["v"].to_pylist(), [np.frombuffer(x, np.int64) for x in held["ids"].to_pylist()]
        sizes = np.array([len(x) for x in raw])
        rows = []
        for o, rank, qid, q in zip(asked["ord"].to_pylist(), asked["rank"].to_pylist(), asked["id"].to_pylist(), asked["v"].to_pylist()):
            low, high = np.searchsorted(ranks, [rank - window, rank + window + 1])
            near = low + np.flatnonzero((ords[low:high] == o) & (sizes[low:high] == len(q)))
            if len(near):
                v = np.frombuffer(b"".join(raw[j] for j in near)).reshape(len(near), -1)
                rows.append((qid, *best_of(np.frombuffer(q), qid, v, [ids[j] for j in near], k)))
        return pa.Table.from_batches([_found(rows)])

    return nearest(placed.groupBy("block").applyInArrow(search, FOUND), k)
