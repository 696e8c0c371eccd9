"""The bank tables, derived from the orders, customer and nation test tables.

Arithmetic only, so that the same tables can be written in any SQL dialect and every
query checked against an independent statement of it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.functions.draws import bucket
from ledgerwatch.functions.expressions import event_time
from ledgerwatch.operators.catalog import Rule
from ledgerwatch.operators.defects import TEST_DRAWS, bucket_draws, inject_defects
from ledgerwatch.operators.warehouse import Warehouse, build_warehouse

AS_OF = datetime(2026, 1, 20)
COPY_OFFSET = 10**15  # out of reach of any number of orders


# The columns that are read; declaring them spares a schema lookup per table.
COLUMNS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as the bank would book them, with a few wrong by nature of the source."""
    customers = table(spark, sf_dir, "customer").agg(F.count(F.lit(1))).scalar()
    base = table(spark, sf_dir, "orders").select(
        F.expr("o_orderkey + 1").alias("txn_id"),
        F.expr("o_orderkey").alias("k"),
        F.expr("o_custkey").alias("ck"),
        customers.alias("customers"),
        F.expr(
            "CAST(IF(o_orderkey % 7 = 5, 100 + o_orderkey % 4, o_orderkey * 7919 % 744) AS INT)"
        ).alias("step"),
        F.expr(
            "get(array('CASH_IN', 'CASH_OUT', 'DEBIT', 'PAYMENT', 'TRANSFER'),"
            " CAST(o_orderkey % 5 AS INT))"
        ).alias("type"),
        F.expr("CAST(IF(o_orderkey % 499 = 11, o_totalprice * 40, o_totalprice) AS DECIMAL(18,2))")
        .alias("amount"),
    )
    return base.selectExpr(
        "txn_id",
        "step",
        "type",
        "amount",
        "concat('C', ck) AS name_orig",
        "CAST(amount + k % 1000 AS DECIMAL(18,2)) AS oldbalance_org",
        "CAST(IF(type = 'CASH_IN', amount + k % 1000 + amount, k % 1000) AS DECIMAL(18,2))"
        " AS newbalance_orig",
        "CASE WHEN type = 'PAYMENT' AND k % 401 <> 3 THEN concat('M', k % 3)"
        " WHEN k % 307 = 1 THEN concat('C', ck)"
        " ELSE concat('C', (ck * 31 + k) % customers) END AS name_dest",
        "CAST(amount + k % 500 AS DECIMAL(18,2)) AS oldbalance_dest",
        "CAST(IF(type = 'CASH_IN', k % 500, amount + k % 500 + amount) AS DECIMAL(18,2))"
        " AS newbalance_dest",
        "CAST(IF(k % 499 = 11, 1, 0) AS SMALLINT) AS is_fraud",
        "CAST(IF(type = 'TRANSFER' AND amount > 200000 AND k % 3 = 0, 1, 0) AS SMALLINT)"
        " AS is_flagged_fraud",
    )


def with_source_defects(clean: DataFrame) -> DataFrame:
    """Defects the injector does not make: NULL type and parties, NULL and negative balances."""
    changed = {
        "type": "IF(_b = 20, NULL, type)",
        "name_orig": "IF(_b = 21, NULL, name_orig)",
        "name_dest": "IF(_b = 22, NULL, name_dest)",
        "newbalance_dest": "IF(_b = 23, NULL, newbalance_dest)",
        "oldbalance_org": "IF(_b = 24, CAST(-5 AS DECIMAL(18,2)), oldbalance_org)",
        "oldbalance_dest": "IF(_b = 25, CAST(-7 AS DECIMAL(18,2)), oldbalance_dest)",
    }
    return clean.withColumn("_b", bucket()).selectExpr(
        *[f"{changed.get(c, c)} AS {c}" for c in clean.columns]
    )


def damaged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Staged transactions with the seeded defects, and their log."""
    source = with_source_defects(clean_transactions(spark, sf_dir))
    return inject_defects(source, bucket_draws(TEST_DRAWS), duplicate_offset=COPY_OFFSET)


def customer_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.expr("c_nationkey = n_nationkey"))
        .selectExpr(
            "*",
            "explode(array_repeat(1, IF(c_custkey % 199 <> 7, 1, 0) + IF(c_custkey % 211 = 3, 1, 0)))"
            " AS _copy",
        )
        .selectExpr(
            "concat('C', c_custkey) AS account_id",
            "c_mktsegment AS segment",
            "get(array('VERIFIED', 'PENDING', 'EXPIRED', 'REJECTED'), CAST(c_custkey % 4 AS INT))"
            " AS kyc_status",
            "n_name AS country",
            "date_add(DATE '2020-01-01', CAST(c_custkey % 1825 AS INT)) AS opened_date",
        )
    )


def settlements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        clean_transactions(spark, sf_dir)
        .where("txn_id % 101 <> 1")
        .selectExpr(
            "concat('SET', lpad(CAST(IF(txn_id % 307 = 5, txn_id - 1, txn_id) AS STRING), 10, '0'))"
            " AS settlement_ref",
            "txn_id",
            "IF(txn_id % 199 = 3, CAST(amount + 1 AS DECIMAL(18,2)), amount) AS settled_amount",
            "date_add(DATE '2026-01-01', CAST(floor(step / 24) AS INT)"
            " + IF(txn_id % 103 = 9, 3 + CAST(txn_id % 5 AS INT), 1)) AS settlement_date",
        )
    )


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return build_warehouse(
        damaged(spark, sf_dir)[0], customer_master(spark, sf_dir), settlements(spark, sf_dir)
    )


GIVEN_TREES, GIVEN_DEPTH = 8, 4


def given_forest(spark: SparkSession) -> DataFrame:
    """A forest by arithmetic on (tree, node), with inner nodes of every feature and leaves at several depths.

    Its path lengths are eighths, so that sums of them are exact in any order.
    """
    inner, every = 2**GIVEN_DEPTH - 1, 2 ** (GIVEN_DEPTH + 1) - 1
    leaf = f"(%s >= {inner} OR (%s >= 3 AND (tree + %s) %% 5 = 0))"
    parent, grand, great = "(node - 1) div 2", "((node - 1) div 2 - 1) div 2", "(((node - 1) div 2 - 1) div 2 - 1) div 2"
    hidden = " OR ".join(f"({n}) > 2 AND {leaf % (f'({n})', f'({n})', f'({n})')}" for n in (parent, grand, great))
    return (
        spark.range(GIVEN_TREES * every)
        .selectExpr(f"CAST(id div {every} AS INT) AS tree", f"CAST(id % {every} AS INT) AS node")
        .where(f"NOT ({hidden})")
        .selectExpr("*", f"{leaf % ('node', 'node', 'node')} AS leaf", "(tree * 7 + node * 3) % 7 AS f",
                    "CAST(floor(log2(node + 1)) AS INT) AS depth")
        .selectExpr(
            "tree", "node", "IF(leaf, -1, CAST(f AS INT)) AS feature",
            "IF(NOT leaf AND f = 6, get(array('CASH_IN', 'CASH_OUT', 'DEBIT', 'PAYMENT', 'TRANSFER'),"
            " CAST((tree + node) % 5 AS INT)), NULL) AS category",
            "CAST(CASE WHEN leaf THEN 0 WHEN f = 0 THEN 8 + (tree * 5 + node) % 5"
            " WHEN f IN (1, 2) THEN ((tree * 31 + node * 17) % 2001 - 1000) * 100"
            " WHEN f IN (3, 4) THEN (tree + node * 13) % 50 * 10000 WHEN f = 5 THEN (tree + node) % 20 / 16 ELSE 0.5 END AS DOUBLE)"
            " AS threshold",
            "IF(node = 0, 256, 1 + (tree + node) % 9) AS rows", "depth",
            "IF(leaf, depth + (tree * 3 + node) % 16 / 8, 0D) AS path",
        )
    )


def as_text(df: DataFrame) -> DataFrame:
    """A typed table as a text feed: NULL is empty."""
    return df.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns]
    )


def daily_run_log(fact: DataFrame, hits: DataFrame, rules: list[Rule]) -> DataFrame:
    """A run log as if every day's transactions had been checked in a run of their own."""
    day = F.to_date(event_time())
    days = fact.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("records_checked"))
    ids = [F.lit(rule.rule_id) for rule in rules if rule.active]
    runs = days.withColumn("rule_id", F.explode(F.array(*ids)))
    failed = (
        hits.join(fact.select("txn_id", day.alias("day")), "txn_id")
        .groupBy("rule_id", "day")
        .agg(F.count(F.lit(1)).alias("records_failed"))
    )
    return runs.join(failed, ["rule_id", "day"], "left").select(
        "rule_id",
        F.col("day").cast("timestamp").alias("run_ts"),
        "records_checked",
        F.coalesce("records_failed", F.lit(0)).cast("bigint").alias("records_failed"),
    )
