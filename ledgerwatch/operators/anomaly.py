"""Isolation forest over transaction features.

Features are column expressions. Each tree is grown on a small bag of rows by one
Python call per tree; the forest has a fixed size bound and is broadcast; scoring is
one vectorised pass. All draws are functions of row id, tree and seed, so partitioning
and retried tasks change nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.functions.expressions import MONEY
from ledgerwatch.operators.selection import kth_smallest, quantile

# Model columns and settings.
NUMERIC = (
    "log_amt",
    "err_orig",
    "err_dest",
    "oldbalance_org",
    "oldbalance_dest",
    "bal_ratio_orig",
)
RATIO_BOUND = 10.0
TREES = 200
BAG = 256
SEED = 42
CONTAMINATION = 0.005
EULER = 0.5772156649015329

DEPTH = 8  # log2 of the bag size
SURPLUS = 4  # bag candidates drawn per bag row
DRAWS = 1 << 40

NODES = (
    "tree int, node int, feature int, category string, threshold double, "
    "rows int, depth int, path double"
)


def features(fact: DataFrame) -> DataFrame:
    """Rows with an amount, cleaned, with the six numeric columns and the type."""
    balances = ("oldbalance_org", "newbalance_orig", "oldbalance_dest", "newbalance_dest")
    zero = F.lit(0).cast(MONEY)
    clean = fact.where("amount IS NOT NULL").select(
        "txn_id",
        F.coalesce("type", F.lit("0")).alias("type"),
        F.greatest("amount", zero).alias("amount"),
        *[F.coalesce(b, zero).alias(b) for b in balances],
        F.coalesce(F.col("is_fraud").cast("int"), F.lit(0)).alias("is_fraud"),
    )
    amount, old = F.col("amount").cast("double"), F.col("oldbalance_org").cast("double")
    ratio = F.when(F.col("oldbalance_org") > 0, amount / old).otherwise(F.lit(0.0))
    return clean.select(
        "txn_id",
        "type",
        "is_fraud",
        F.log1p(amount).alias("log_amt"),
        (F.col("oldbalance_org") - F.col("newbalance_orig") - F.col("amount"))
        .cast("double")
        .alias("err_orig"),
        (F.col("newbalance_dest") - F.col("oldbalance_dest") - F.col("amount"))
        .cast("double")
        .alias("err_dest"),
        old.alias("oldbalance_org"),
        F.col("oldbalance_dest").cast("double").alias("oldbalance_dest"),
        F.greatest(F.lit(-RATIO_BOUND), F.least(F.lit(RATIO_BOUND), ratio)).alias("bal_ratio_orig"),
    )


def one_hot_types(rows: DataFrame) -> DataFrame:
    """A 0/1 column per type, in order of name. The model itself needs no such columns.

    The names become columns, so the driver has to hold them, however many there are.
    """
    found = rows.select("type").distinct().orderBy("type").collect()
    flags = [(F.col("type") == row[0]).cast("int").alias(f"type_{row[0]}") for row in found]
    return rows.select(*[c for c in rows.columns if c != "type"], *flags)


# --- training -----------------------------------------------------------------------


def _draw(*columns: Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(DRAWS))


def bags(
    rows: DataFrame, count: int, trees: int = TREES, bag: int = BAG, seed: int = SEED
) -> DataFrame:
    """The rows of each tree's bag, with their rank in it; `count` is the number of rows.

    A bag is the rows with the lowest draws for that tree. Candidates are found by drawing
    trees for rows, four times as many as needed in all: with many rows most draw none, so the
    work after the first hash does not grow with the table; with few, each tries several trees or all.
    """
    if count == 0:
        raise ValueError("no rows to train on")
    key, salt = F.col("txn_id"), F.lit(seed)
    # a row's turns go to different trees: steps of its own size around a prime number of places
    places = next(p for p in range(max(2, trees), 2 * trees + 2) if all(p % d for d in range(2, math.isqrt(p) + 1)))
    wanted = SURPLUS * places * bag / count  # turns of a row, counting places without a tree
    turns = min(places, math.ceil(wanted))
    lucky = F.lit(int(min(1.0, wanted / turns) * DRAWS))
    turn = F.explode(F.sequence(F.lit(0), F.lit(turns - 1))) if turns > 1 else F.lit(0)
    first, step = F.pmod(F.xxhash64(key, salt), F.lit(places)), 1 + F.pmod(F.xxhash64(salt, key), F.lit(places - 1))
    tried = (
        rows.withColumn("_turn", turn)
        .where(_draw(key, F.col("_turn"), salt) < lucky)
        .withColumn("tree", F.pmod(first + F.col("_turn") * step, F.lit(places)))
        .where(F.col("tree") < trees)
        .drop("_turn")
    )
    order = Window.partitionBy("tree").orderBy("_draw", "txn_id")
    return (
        tried.withColumn("tree", F.col("tree").cast("int"))
        .withColumn("_draw", _draw(key, F.col("tree"), salt))
        .withColumn("rank", F.dense_rank().over(order))  # a tree drawn twice is one place
        .where(F.col("rank") <= bag)
        .dropDuplicates(["tree", "rank"])
        .drop("_draw", "is_fraud")
    )


def mean_path(rows: int) -> float:
    """Mean path length of an unsuccessful search among `rows` points."""
    if rows <= 1:
        return 0.0
    if rows == 2:
        return 1.0
    return 2.0 * (math.log(rows - 1.0) + EULER) - 2.0 * (rows - 1.0) / rows


def _grow(pdf: pd.DataFrame, seed: int) -> pd.DataFrame:
    """One tree. Node i has children 2i+1 (at or below the threshold) and 2i+2."""
    pdf = pdf.sort_values("rank")
    tree = int(pdf["tree"].iloc[0])
    rng = np.random.default_rng([seed, tree])
    values = pdf[list(NUMERIC)].to_numpy(dtype=np.float64)
    types = pdf["type"].to_numpy(dtype=object)
    nodes = []
    todo = [(0, 0, np.arange(len(pdf)))]
    while todo:
        node, depth, index = todo.pop()
        low, high = values[index].min(axis=0), values[index].max(axis=0)
        choices: list = list(np.flatnonzero(high > low))
        present = sorted(set(types[index]))
        if len(present) > 1:
            choices += present  # each type is a 0/1 column that varies here
        if depth == DEPTH or len(index) <= 1 or not choices:
            path = depth + mean_path(len(index))
            nodes.append((tree, node, -1, None, 0.0, len(index), depth, path))
            continue
        choice = choices[rng.integers(len(choices))]
        if isinstance(choice, str):
            right = types[index] == choice
            nodes.append((tree, node, len(NUMERIC), choice, 0.5, len(index), depth, 0.0))
        else:
            cut = float(rng.uniform(low[choice], high[choice]))
            right = values[index, choice] > cut
            nodes.append((tree, node, int(choice), None, cut, len(index), depth, 0.0))
        todo.append((2 * node + 2, depth + 1, index[right]))
        todo.append((2 * node + 1, depth + 1, index[~right]))
    return pd.DataFrame(nodes, columns=[part.split()[0] for part in NODES.split(", ")])


def train(
    rows: DataFrame,
    trees: int = TREES,
    bag: int = BAG,
    seed: int = SEED,
    count: int | None = None,
) -> DataFrame:
    """The forest as a table of nodes: at most `trees * 511` rows."""
    count = rows.count() if count is None else count
    return (
        bags(rows, count, trees, bag, seed)
        .groupBy("tree")
        .applyInPandas(lambda pdf: _grow(pdf, seed), NODES)
    )


# --- scoring ------------------------------------------------------------------------


@dataclass(frozen=True)
class Forest:
    """Full binary trees as arrays. A leaf above the last level sends all rows left."""

    feature: np.ndarray  # (trees, 255)
    above: np.ndarray  # a row goes right if above < value <= upto
    upto: np.ndarray
    path: np.ndarray  # (trees, 256)
    types: dict[str, int]
    norm: float


def pack(nodes: DataFrame) -> Forest:
    """Collect the node table (bounded: at most 511 rows a tree) into arrays."""
    table = nodes.toPandas()
    trees = int(table["tree"].max()) + 1
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    feature = np.zeros((trees, inner), dtype=np.int32)
    above = np.full((trees, inner), np.inf)
    upto = np.full((trees, inner), np.inf)
    path = np.zeros((trees, leaves))
    names = sorted(table["category"].dropna().unique())
    types = {name: code for code, name in enumerate(names)}
    for row in table.itertuples(index=False):
        if row.feature < 0:
            slot = row.node
            for _ in range(DEPTH - row.depth):
                slot = 2 * slot + 1
            path[row.tree, slot - inner] = row.path
        elif row.category is not None and row.feature == len(NUMERIC):
            feature[row.tree, row.node] = row.feature
            above[row.tree, row.node] = types[row.category] - 0.5
            upto[row.tree, row.node] = types[row.category] + 0.5
        else:
            feature[row.tree, row.node] = row.feature
            above[row.tree, row.node] = row.threshold
    roots = table[table["node"] == 0]
    return Forest(feature, above, upto, path, types, mean_path(int(roots["rows"].max())))


def walk(forest: Forest, matrix: np.ndarray) -> np.ndarray:
    """Scores of the columns of a (features, rows) matrix; higher is more unusual.

    All rows go down one tree at a time. The buffers are reused, as this is the one place
    where every row meets every tree.
    """
    count, inner = matrix.shape[1], 2**DEPTH - 1
    values, lane = matrix.ravel(), np.arange(count, dtype=np.int32)
    total = np.zeros(count)
    slot = np.empty(count, dtype=np.int32)
    value, bound = np.empty(count), np.empty(count)
    right, inside = np.empty(count, dtype=bool), np.empty(count, dtype=bool)
    starts = (forest.feature * count).astype(np.int32)
    bounded = np.isfinite(forest.upto).any(axis=1)
    for tree, start in enumerate(starts):
        node = np.zeros(count, dtype=np.int32)
        for _ in range(DEPTH):
            start.take(node, out=slot, mode="clip")
            slot += lane
            values.take(slot, out=value, mode="clip")
            forest.above[tree].take(node, out=bound, mode="clip")
            np.greater(value, bound, out=right)
            if bounded[tree]:
                forest.upto[tree].take(node, out=bound, mode="clip")
                np.less_equal(value, bound, out=inside)
                right &= inside
            node *= 2
            node += 1
            node += right
        total += forest.path[tree].take(node - inner)
    depth = total / len(starts)
    return 2.0 ** (-depth / forest.norm) if forest.norm > 0 else np.full(count, 0.5)


def score(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(txn_id, is_fraud, type, score) of every row; an input of few parts is dealt out to all cores first."""
    context = rows.sparkSession.sparkContext
    forest = context.broadcast(pack(nodes))
    if rows.rdd.getNumPartitions() < context.defaultParallelism:
        rows = rows.repartition(context.defaultParallelism, "txn_id")

    @F.pandas_udf("double")
    def forest_score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = forest.value
        for kind, *numbers in batches:
            codes = kind.map(model.types).fillna(-1.0).to_numpy(dtype=np.float64)
            matrix = np.vstack([n.to_numpy(dtype=np.float64) for n in numbers] + [codes])
            yield pd.Series(walk(model, matrix))

    return rows.select(
        "txn_id", "is_fraud", "type", forest_score("type", *NUMERIC).alias("score")
    )


def flag(scored: DataFrame, contamination: float = CONTAMINATION) -> DataFrame:
    """Adds is_anomaly: a score above the exact (1 - contamination) quantile.

    Pass a written table: the quantile reads the score column twice, the flag once more.
    """
    if scored.isEmpty():
        return scored.withColumn("is_anomaly", F.lit(False))
    cut = quantile(scored, "score", 1 - contamination)
    return scored.withColumn("is_anomaly", F.col("score") > F.lit(cut))


def evaluate(scored: DataFrame, share: float = CONTAMINATION) -> DataFrame:
    """Precision, recall, lift and confusion counts of the top share of scores.

    The top is cut at its lowest score; among rows that tie there the lowest ids are in.
    """
    count = scored.count()
    if count == 0:
        raise ValueError("nothing to evaluate")
    k = max(1, int(count * share))
    cut = kth_smallest(scored, "score", count - k)
    sure = scored.where(F.col("score") > F.lit(cut)).count()
    tied = scored.where(F.col("score") == F.lit(cut))
    last_id = kth_smallest(tied, "txn_id", k - sure - 1)
    top = (F.col("score") > F.lit(cut)) | (
        (F.col("score") == F.lit(cut)) & (F.col("txn_id") <= F.lit(last_id))
    )
    fraud = F.col("is_fraud") == 1
    sums = scored.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(top).alias("k"),
        F.count_if(fraud).alias("frauds"),
        F.count_if(top & fraud).alias("true_positives"),
    )
    precision = F.col("true_positives") / F.col("k")
    recall = F.col("true_positives") / F.greatest(F.col("frauds"), F.lit(1))
    base = F.nullif(F.col("frauds") / F.col("records"), F.lit(0.0))
    return sums.select(
        "records",
        "k",
        "frauds",
        "true_positives",
        (F.col("k") - F.col("true_positives")).alias("false_positives"),
        (F.col("frauds") - F.col("true_positives")).alias("false_negatives"),
        (F.col("records") - F.col("k") - F.col("frauds") + F.col("true_positives")).alias(
            "true_negatives"
        ),
        F.round(precision, 4).alias("precision_at_k"),
        F.round(recall, 4).alias("recall_at_k"),
        F.round(precision / base, 4).alias("lift"),
    )


def flag_counts(scores: DataFrame) -> DataFrame:
    """Rows, share and score range by flag."""
    total = scores.agg(F.count(F.lit(1))).scalar()
    return scores.groupBy("is_anomaly").agg(
        F.count(F.lit(1)).alias("txn_count"),
        (100 * F.count(F.lit(1)) / F.first(total)).alias("share_pct"),
        F.min("score").alias("min_score"),
        F.avg("score").alias("mean_score"),
        F.max("score").alias("max_score"),
    )
