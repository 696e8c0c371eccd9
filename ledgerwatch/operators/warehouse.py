"""Star schema: dimensions, fact, and the key checks that guard them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.functions.expressions import DIRECTIONS, event_time


@dataclass(frozen=True)
class Warehouse:
    """The tables the rules read. `scores` exists once the anomaly model has run, and
    `injected_defects` where defects were seeded."""

    fact: DataFrame
    customer_master: DataFrame
    settlements: DataFrame
    dim_customer: DataFrame
    scores: DataFrame | None = None
    injected_defects: DataFrame | None = None


def dim_customer(customer_master: DataFrame) -> DataFrame:
    """One row per account: the least of its rows, column by column, NULL lowest.

    The least row is an aggregate, so copies of one account are folded before the shuffle.
    """
    others = [c for c in customer_master.columns if c != "account_id"]
    return (
        customer_master.groupBy("account_id")
        .agg(F.min(F.struct(*others)).alias("_row"))
        .select("account_id", *[F.col(f"_row.{c}").alias(c) for c in others])
    )


def dim_txn_type(spark: SparkSession, existing: DataFrame | None = None) -> DataFrame:
    """The five types; with an existing dimension, only types it lacks are added."""
    rows = [(i, t, d) for i, (t, d) in enumerate(DIRECTIONS, start=1)]
    fresh = spark.createDataFrame(rows, "type_id int, type string, direction string")
    if existing is None:
        return fresh
    return existing.unionByName(fresh.join(existing, "type", "left_anti").select(fresh.columns))


def dim_time(staged: DataFrame) -> DataFrame:
    """One row per hour number in use; fields are derived after the distinct."""
    moment = staged.select(F.col("step").alias("time_key")).distinct()
    at = event_time("time_key")
    return moment.select(
        "time_key",
        at.alias("txn_ts"),
        F.hour(at).alias("hour_of_day"),
        (F.dayofweek(at) - 1).alias("day_of_week"),  # 0 is Sunday
        F.weekofyear(at).alias("week_num"),
        F.month(at).alias("month_num"),
    )


def fact_transactions(staged: DataFrame) -> DataFrame:
    rest = [c for c in staged.columns if c not in ("txn_id", "step")]
    return staged.select("txn_id", "step", event_time().alias("txn_ts"), *rest)


def build_warehouse(
    staged: DataFrame, customer_master: DataFrame, settlements: DataFrame
) -> Warehouse:
    return Warehouse(
        fact_transactions(staged), customer_master, settlements, dim_customer(customer_master)
    )


def key_violations(df: DataFrame, key: str, table: str) -> DataFrame:
    """Keys that are NULL or used more than once."""
    return (
        df.groupBy(F.col(key).alias("key_value"))
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 OR key_value IS NULL")
        .select(F.lit(table).alias("table_name"), F.col("key_value").cast("string").alias("key_value"), "copies")
    )


def require_key(df: DataFrame, key: str, table: str) -> DataFrame:
    """Fail if `key` is not unique and set; else the frame itself."""
    broken = key_violations(df, key, table).take(3)
    if broken:
        raise ValueError(f"{table}.{key} is not a key: {[tuple(row) for row in broken]}")
    return df


def catalog_violations(catalog: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Severities outside the domain, repeated rule codes, and findings of unknown rules."""
    # The severity domain.
    severities = ("HIGH", "MEDIUM", "LOW")
    domain = catalog.where(~F.col("severity").isin(*severities)).select(
        F.lit("severity").alias("check_name"), F.col("rule_code").alias("value")
    )
    repeated = (
        catalog.groupBy("rule_code")
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select(F.lit("rule_code").alias("check_name"), F.col("rule_code").alias("value"))
    )
    # few distinct rule ids are left after the aggregate, so the anti join is small
    unknown = (
        exceptions.select("rule_id")
        .distinct()
        .join(catalog, "rule_id", "left_anti")
        .select(F.lit("rule_id").alias("check_name"), F.col("rule_id").cast("string").alias("value"))
    )
    return domain.unionByName(repeated).unionByName(unknown)


def account_universe(staged: DataFrame) -> DataFrame:
    """Distinct customer accounts (C prefix) of either side, in one scan."""
    sides = staged.select(F.explode(F.array("name_orig", "name_dest")).alias("account_id"))
    return sides.where(F.col("account_id").startswith("C")).distinct()


def star_join_daily(fact: DataFrame, customers: DataFrame, spark: SparkSession) -> DataFrame:
    """Transactions by day, origin segment and direction.

    The fact meets the customer dimension once, on the account, and is folded to a few rows a day
    by each task before the second shuffle. A dimension that turns out small enough is broadcast
    instead, and a busy account's rows are dealt to several tasks (adaptive execution does both).
    """
    types = dim_txn_type(spark).select("type", "direction")
    who = customers.select(F.col("account_id").alias("name_orig"), "segment")
    # the time dimension is a function of its key, so its fields are derived, not joined
    return (
        fact.select("name_orig", "type", "step", "amount")
        .join(who, "name_orig", "left")
        .join(F.broadcast(types), "type", "left")
        .groupBy(F.to_date(event_time()).alias("txn_date"), "segment", "direction")
        .agg(F.count(F.lit(1)).alias("txns"), F.sum("amount").alias("total_amount"))
    )
