import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import anomaly
from ledgerwatch.operators import selection
from ledgerwatch.plans import testbed as tb
from ledgerwatch.session import settle


@pytest.mark.parametrize("bins", [6, 4096])
def test_selection_is_exact(spark, monkeypatch, bins):
    monkeypatch.setattr(selection, "BINS", bins)
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(size=300), np.full(200, 0.25), [1e9, -1e9, 0.0]])
    frame = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").cache()
    ordered = np.sort(values)
    for k in (0, 1, 250, 501, 502):
        assert selection.kth_smallest(frame, "v", k) == ordered[k]
    for q in (0.0, 0.25, 0.995, 1.0):
        assert selection.quantile(frame, "v", q) == pytest.approx(np.quantile(values, q), rel=1e-12)
    whole = spark.range(1000).selectExpr("(id * 7919) % 1000 - 400 AS v")
    assert [selection.kth_smallest(whole, "v", k) for k in (0, 333, 999)] == [-400, -67, 599]
    with pytest.raises(ValueError):
        selection.kth_smallest(whole, "v", 1000)


def counted_scans(spark, values):
    """The values as a frame that counts its rows each time they are read."""
    read = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    frame = settle(spark.createDataFrame([(float(v),) for v in values], "v double"))[0]
    return frame.mapInArrow(run, "v double"), read


@pytest.mark.parametrize("q", [0.0, 0.3, 0.995, 1.0])
def test_a_quantile_reads_the_column_twice(spark, q):
    values = np.concatenate([np.random.default_rng(7).normal(size=30_000), np.full(15_000, 0.5)])
    frame, read = counted_scans(spark, values)
    assert selection.quantile(frame, "v", q) == pytest.approx(np.quantile(values, q), rel=1e-12)
    assert read.value == 2 * len(values)


def test_a_sketch_that_misses_costs_a_scan(spark, monkeypatch):
    monkeypatch.setattr(selection, "SKETCH", 8)
    monkeypatch.setattr(selection, "MARGIN", 0.0)
    values = np.random.default_rng(8).permutation(40_000).astype(float)
    frame, read = counted_scans(spark, values)
    assert [selection.kth_smallest(frame, "v", k) for k in (777, 20_000, 39_000)] == [777, 20_000, 39_000]
    assert read.value > 2 * 3 * len(values)


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return settle(anomaly.features(tb.warehouse(spark, sf_dir).fact))[0]


@pytest.fixture(scope="module")
def forest(spark, rows):
    return settle(anomaly.train(rows, trees=20))[0]


def test_forest_ignores_layout(spark, rows, forest):
    again = anomaly.train(rows.repartition(11), trees=20)
    assert forest.exceptAll(again).isEmpty() and again.exceptAll(forest).isEmpty()
    assert anomaly.train(rows, trees=20, seed=7).exceptAll(forest).count() > 0


def test_tree_shape(forest):
    roots = forest.where("node = 0").agg(F.count(F.lit(1)), F.min("rows"), F.max("rows")).first()
    assert roots == (20, anomaly.BAG, anomaly.BAG)
    assert forest.agg(F.max("depth")).first()[0] <= anomaly.DEPTH
    leaves = forest.where("feature = -1").groupBy("tree").agg(F.sum("rows").alias("rows"))
    assert [r["rows"] for r in leaves.collect()] == [anomaly.BAG] * 20


@pytest.mark.parametrize("count", [40, 300, 1500])
def test_bags_are_whole_and_distinct(spark, rows, count):
    some = rows.orderBy("txn_id").limit(count)
    bags = anomaly.bags(some, some.count(), trees=9, bag=64)
    sizes = bags.groupBy("tree").agg(F.count(F.lit(1)), F.countDistinct("txn_id")).collect()
    assert [tuple(r)[1:] for r in sizes] == [(min(64, some.count()),) * 2] * 9


def test_walk_equals_a_plain_descent(spark, rows, forest):
    table = forest.toPandas()
    nodes = {(r.tree, r.node): r for r in table.itertuples()}
    sample = rows.limit(40).toPandas()

    def depth(row, tree):
        node = 0
        while True:
            at = nodes[tree, node]
            if at.feature < 0:
                return at.path
            if at.feature == len(anomaly.NUMERIC):
                right = row["type"] == at.category
            else:
                right = row[anomaly.NUMERIC[at.feature]] > at.threshold
            node = 2 * node + (2 if right else 1)

    norm = anomaly.mean_path(anomaly.BAG)
    want = {
        row["txn_id"]: 2 ** (-np.mean([depth(row, t) for t in range(20)]) / norm)
        for _, row in sample.iterrows()
    }
    ids = spark.createDataFrame([(int(i),) for i in want], "txn_id bigint")
    scored = anomaly.score(rows.join(ids, "txn_id"), forest)
    got = {r["txn_id"]: r["score"] for r in scored.collect()}
    assert got == pytest.approx(want)


def test_unseen_type_takes_no_type_branch(spark, rows, forest):
    odd = rows.limit(5).withColumn("type", F.lit("NEVER_SEEN"))
    assert odd.count() == anomaly.score(odd, forest).where("score > 0 AND score < 1").count()


def test_outliers_rank_on_top(spark, rows):
    planted = rows.limit(3).selectExpr(
        "txn_id + 90000000 AS txn_id", "'WIRE' AS type", "1 AS is_fraud", "log_amt + 20 AS log_amt",
        "-5.0e9 AS err_orig", "5.0e9 AS err_dest", "9.0e9 AS oldbalance_org",
        "9.0e9 AS oldbalance_dest", "-10.0D AS bal_ratio_orig",
    ).selectExpr(*[f"CAST({c} AS {t}) AS {c}" for c, t in rows.dtypes])
    both, _ = settle(rows.unionByName(planted))
    trained = anomaly.train(both, trees=60)
    scored = settle(anomaly.score(both, trained))[0]
    top = {r["txn_id"] for r in scored.orderBy(F.desc("score")).limit(5).collect()}
    assert {r["txn_id"] for r in planted.collect()} <= top
    flagged = anomaly.flag(scored)
    count = scored.count()
    assert 0 < flagged.where("is_anomaly").count() <= int(0.005 * count) + 1
    metrics = anomaly.evaluate(flagged).first()
    assert metrics["k"] == int(0.005 * count) and metrics["true_positives"] >= 3
    by_flag = {r["is_anomaly"]: r for r in anomaly.flag_counts(flagged).collect()}
    assert by_flag[True]["min_score"] > by_flag[False]["max_score"]


def test_types_as_columns(spark, rows):
    wide = anomaly.one_hot_types(rows)
    flags = [c for c in wide.columns if c.startswith("type_")]
    assert flags == sorted(flags) and "type_0" in flags
    assert wide.where(" + ".join(f"`{c}`" for c in flags) + " <> 1").isEmpty()


def test_nothing_to_train_on(spark, rows):
    with pytest.raises(ValueError):
        anomaly.train(rows.where("false"))
