"""Recall of the rules against the seeded defects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rule that should catch each seeded defect.
EXPECTED_RULE = {
    "NULL_AMOUNT": "NULL_AMOUNT",
    "NEG_AMOUNT": "NEG_AMOUNT",
    "DUP_TXN": "DUP_BUSINESS_KEY",
    "BAD_ACCT_FORMAT": "BAD_ACCT_FORMAT",
    "INVALID_TYPE": "INVALID_TYPE",
    "BAL_TAMPERING": "BAL_ORIG_MISMATCH",
    "STEP_OUT_OF_RANGE": "STEP_OUT_OF_RANGE",
    "ZERO_AMOUNT": "ZERO_AMOUNT",
}


def _percent(caught: Column, injected: Column) -> Column:
    share = caught.cast("decimal(20,0)") / injected.cast("decimal(20,0)")
    return F.round(100 * share, 1).alias("recall_pct")


def recall_literal(defects: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Recall by transaction alone: a defect counts once per exception on its transaction.

    Kept for parity; it inflates both counts. `recall_attributed` is the honest figure. The queue
    is narrowed to the defects' transactions first: a small log is broadcast for that.
    """
    wanted = defects.select("txn_id").where("txn_id IS NOT NULL").distinct()
    per_txn = (
        exceptions.select("txn_id").join(wanted, "txn_id", "left_semi")
        .groupBy("txn_id")
        .agg(F.count(F.lit(1)).alias("found"))
    )
    return (
        defects.join(per_txn, "txn_id", "left")
        .groupBy("defect_type")
        .agg(
            F.sum(F.coalesce("found", F.lit(1))).alias("injected"),
            F.sum(F.coalesce("found", F.lit(0))).alias("caught"),
        )
        .select("defect_type", "injected", "caught", _percent(F.col("caught"), F.col("injected")))
    )


def recall_attributed(defects: DataFrame, exceptions: DataFrame, catalog: DataFrame) -> DataFrame:
    """Recall by the rule that should have caught the defect, each defect once."""
    pairs = [F.lit(x) for pair in EXPECTED_RULE.items() for x in pair]
    expected = defects.distinct().withColumn(
        "rule_code", F.element_at(F.create_map(*pairs), F.col("defect_type"))
    )
    # the expected codes narrow the queue before it is shuffled
    fired = (
        exceptions.join(catalog.select("rule_id", "rule_code"), "rule_id")
        .where(F.col("rule_code").isin(*EXPECTED_RULE.values()))
        .select("rule_code", "txn_id")
        .distinct()
        .withColumn("hit", F.lit(1))
    )
    return (
        expected.join(fired, ["txn_id", "rule_code"], "left")
        .groupBy("defect_type", "rule_code")
        .agg(F.count(F.lit(1)).alias("injected"), F.count("hit").alias("caught"))
        .select(
            "defect_type",
            "rule_code",
            "injected",
            "caught",
            _percent(F.col("caught"), F.col("injected")),
        )
    )
