"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.session import settle


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): nodes that are joined have one root.

    In each round every node hooks to whichever of itself and its neighbours has the least hash of
    the round, twice over, and the edges are drawn between what they hook to. A constant share of
    the nodes goes in each round, so rounds grow with the logarithm of the longest chain. Every
    round is a written table. Edges from a node to itself name nodes alone.
    """
    edges, seen = settle(edges.select("a", "b"))
    roots, number = None, 0
    while seen["rows"]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = F.xxhash64("b", F.lit(number))
        near = both.unionByName(both.select("a", F.col("a").alias("b"))).groupBy("a").agg(F.min(F.struct(rank.alias("h"), "b")).alias("m"))
        hooks, _ = settle(near.select(F.col("a").alias("node"), F.col("m.b").alias("to")))
        again = hooks.select(F.col("node").alias("to"), F.col("to").alias("further"))
        # the second step: where the first one leads may hook on itself
        hooks, _ = settle(hooks.join(again, "to").select("node", F.col("further").alias("to")))
        if roots is None:
            roots, _ = settle(hooks.select("node", F.col("to").alias("root")))
        else:
            moved = hooks.select(F.col("node").alias("root"), F.col("to").alias("new"))
            roots, _ = settle(roots.join(moved, "root", "left").select("node", F.coalesce("new", "root").alias("root")))
        left = hooks.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        right = hooks.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        # hooking moves a node along edges, so the way it went is an edge to keep, too
        ways = edges.join(left, "a").join(right, "b").select(F.col("ta").alias("a"), F.col("tb").alias("b"))
        edges, seen = settle(ways.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        number += 1
    if roots is None:
        spark = edges.sparkSession
        kind = edges.schema["a"].dataType.simpleString()
        return spark.createDataFrame([], f"node {kind}, root {kind}")
    return roots
