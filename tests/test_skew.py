"""A third of the rows on one key: same results, and no task that holds them all."""

from builders import AS_OF
from pyspark.sql import functions as F

from ledgerwatch.functions.lookups import Limits, heaviest, join_back, make_lookup
from ledgerwatch.operators.catalog import standard_rules
from ledgerwatch.operators.rules import failing
from ledgerwatch.operators.warehouse import Warehouse
from ledgerwatch.plans import testbed as tb

RULES = standard_rules()


def skewed(spark, sf_dir):
    """Every third transaction goes from one account to one account at one time."""
    wh = tb.warehouse(spark, sf_dir)
    third = "txn_id % 3 = 0"
    fact = wh.fact.selectExpr(
        "txn_id",
        f"IF({third}, 7, step) AS step",
        "txn_ts",
        f"IF({third}, 'DEBIT', type) AS type",
        f"IF({third}, CAST(50 AS DECIMAL(18,2)), amount) AS amount",
        f"IF({third}, 'C5', name_orig) AS name_orig",
        "oldbalance_org",
        "newbalance_orig",
        f"IF({third}, 'C999999', name_dest) AS name_dest",
        "oldbalance_dest",
        "newbalance_dest",
        "is_fraud",
        "is_flagged_fraud",
    )
    settlements = wh.settlements.selectExpr(
        f"IF({third}, 'SAME', settlement_ref) AS settlement_ref",
        "IF(txn_id % 3 = 1, 4, txn_id) AS txn_id",
        "settled_amount",
        "settlement_date",
    )
    return Warehouse(fact, wh.customer_master, settlements, wh.dim_customer)


def counts(hits):
    return {tuple(r) for r in hits.groupBy("rule_id").agg(F.count(F.lit(1)), F.sum("txn_id")).collect()}


def test_hot_keys_same_results(spark, sf_dir):
    wh = skewed(spark, sf_dir)
    plain = counts(failing(wh, RULES, AS_OF))
    split = Limits(rows=0, hot_rows=50, hot_keys=5)
    assert counts(failing(wh, RULES, AS_OF, split)) == plain
    # against a direct statement of three of the rules
    fact, third = wh.fact, wh.fact.where("txn_id % 3 = 0").count()
    by_id = {row[0]: row[1] for row in plain}
    assert by_id[19] >= third - 1
    assert by_id[23] >= third
    assert by_id[29] >= third
    assert fact.count() > third


def test_hot_rows_do_not_reach_the_shuffle(spark):
    """The heavy key is joined map-side; what is left for the shuffle join has small groups only."""
    rows = spark.range(9000).selectExpr("id", "IF(id % 3 = 0, -1, id) AS key")
    findings = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    lookup = make_lookup(findings, ("key",), Limits(rows=10, hot_rows=100, hot_keys=3))
    assert not lookup.fits
    joined = join_back(rows, lookup)
    assert joined.count() == 9000
    assert joined.where("key = -1").count() == 3000
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "Union" in plan


def test_keys_too_long_to_broadcast_are_not_heavy(spark):
    rows = spark.createDataFrame([("x" * 50,)] * 8 + [("y",)] * 5 + [("z",)] * 2, "key string")
    findings = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    limits = Limits(rows=0, bytes=1000, hot_keys=10, hot_rows=2)
    lookup = make_lookup(findings, ("key",), limits)
    assert [r.key for r in heaviest(lookup.frame, ("key",), limits).collect()] == ["y", "z"]
    assert join_back(rows, lookup).count() == 15
