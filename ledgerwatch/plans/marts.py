"""Reporting marts and measures over the run log, the queue and the fact."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.operators.queue import instant

# The wording and the line order of the summary text.
SUMMARY_EMPTY = "No rule failures detected in the latest run. All checks passed."
SUMMARY_ADVICE = (
    "Recommended: Review HIGH-severity exceptions first, "
    "investigate root cause in source data, and update remediation plan."
)
TOP_RULES = 10


def _named(catalog: DataFrame) -> DataFrame:
    """A short table: Spark broadcasts it by its known size."""
    return catalog.select("rule_id", "rule_code", "dimension", "severity")


def _failed_share() -> Column:
    checked = F.nullif(F.col("records_checked"), F.lit(0).cast("bigint")).cast("decimal(20,0)")
    return F.col("records_failed").cast("decimal(20,0)") / checked


def _pass_rate() -> Column:
    return 100 * (1 - _failed_share())


def rule_scorecard(log: DataFrame, catalog: DataFrame) -> DataFrame:
    """Pass rate per rule and run; NULL where nothing was checked."""
    return log.join(_named(catalog), "rule_id").select(
        "rule_code",
        "dimension",
        "severity",
        F.to_date("run_ts").alias("run_date"),
        "records_checked",
        "records_failed",
        F.round(_pass_rate(), 3).alias("pass_rate_pct"),
    )


def exception_ageing(exceptions: DataFrame, catalog: DataFrame, as_of: datetime) -> DataFrame:
    """Open exceptions by severity and age; a full day or week is in the older bucket."""
    now, found = instant(as_of), F.col("detected_at")
    age = (
        F.when(found + F.expr("INTERVAL '1' DAY") > now, F.lit("0-1d"))
        .when(found + F.expr("INTERVAL '7' DAY") > now, F.lit("1-7d"))
        .otherwise(F.lit("7d+"))
    )
    return (
        exceptions.where("status = 'OPEN'")
        .groupBy("rule_id", age.alias("age_bucket"))
        .agg(F.count(F.lit(1)).alias("open_count"))
        .join(_named(catalog), "rule_id")
        .groupBy("severity", "age_bucket")
        .agg(F.sum("open_count").alias("open_exceptions"))
    )


def daily_control(log: DataFrame, catalog: DataFrame) -> DataFrame:
    """Failures, mean pass rate and service level by day, dimension and severity.

    The level (a pass rate of 0.99 or more) is tested on whole numbers, so a rate of
    exactly 0.99 meets it.
    """
    met = F.when(
        F.col("records_checked") != 0, F.col("records_failed") * 100 <= F.col("records_checked")
    )
    return (
        log.join(_named(catalog), "rule_id")
        .groupBy(F.to_date("run_ts").alias("run_date"), "dimension", "severity")
        .agg(
            F.sum("records_failed").alias("failed"),
            F.round(F.avg(_pass_rate()), 3).alias("avg_pass_rate_pct"),
            F.bool_and(met).alias("sla_met"),
        )
    )


def exception_detail(exceptions: DataFrame, catalog: DataFrame, fact: DataFrame) -> DataFrame:
    """Drill-through rows. Exceptions on transactions outside the fact are left out."""
    found = exceptions.join(_named(catalog), "rule_id").select(
        "exception_id",
        "rule_code",
        "dimension",
        "severity",
        "detected_at",
        "status",
        "assigned_to",
        "resolved_at",
        "note",
        "txn_id",
    )
    about = fact.select(
        "txn_id",
        "step",
        "txn_ts",
        "type",
        "amount",
        "name_orig",
        "name_dest",
        "is_fraud",
        "is_flagged_fraud",
    )
    columns = found.columns + [c for c in about.columns if c != "txn_id"]
    return found.join(about, "txn_id").select(*columns)


def anomaly_overview(fact: DataFrame, scores: DataFrame) -> DataFrame:
    about = fact.select(
        "txn_id", "txn_ts", "type", "amount", "name_orig", "name_dest", "is_fraud"
    )
    scored = scores.select("txn_id", F.col("score").alias("anomaly_score"), "is_anomaly")
    return about.join(scored, "txn_id")


def top_failing_rules(scorecard: DataFrame, limit: int = TOP_RULES) -> DataFrame:
    """The rules with most failures on the latest day; equal counts go by rule code."""
    latest = scorecard.agg(F.max("run_date")).scalar()
    return (
        scorecard.where(F.col("run_date") == latest)
        .orderBy(F.desc("records_failed"), "rule_code")
        .limit(limit)
        .select("rule_code", "dimension", "severity", "records_failed", "pass_rate_pct")
    )


def control_summary(top_rules: DataFrame, report_date: date) -> DataFrame:
    """One row (run_date, summary): the report text over the top rules (a fixed, small number)."""
    row = F.struct(
        (-F.col("records_failed")).alias("minus"),
        "rule_code",
        "dimension",
        "severity",
        F.col("pass_rate_pct").cast("double").alias("pass_rate"),
    )
    listed = top_rules.agg(
        F.sum("records_failed").alias("total"), F.sort_array(F.collect_list(row)).alias("rules")
    )
    high = F.transform(
        F.filter("rules", lambda r: r["severity"] == "HIGH"), lambda r: r["rule_code"]
    )
    worst = F.try_element_at("rules", F.lit(1))
    lines = F.array(
        F.lit(f"Daily DQ Report - {report_date.isoformat()}"),
        F.format_string("Total exceptions across top rules: %,d", "total"),
        F.when(
            F.size(high) > 0,
            F.concat(F.lit("HIGH severity rules failing: "), F.array_join(high, ", ")),
        ),
        F.format_string(
            "Worst performing rule: %s (%s) with %,d failures (pass rate: %s%%)",
            worst["rule_code"],
            worst["dimension"],
            -worst["minus"],
            worst["pass_rate"].cast("string"),
        ),
        F.lit(SUMMARY_ADVICE),
    )
    text = F.when(F.size("rules") == 0, F.lit(SUMMARY_EMPTY)).otherwise(F.array_join(lines, "\n"))
    return listed.select(
        F.lit(report_date.isoformat()).cast("date").alias("run_date"), text.alias("summary")
    )


def latest_summary(summaries: DataFrame) -> DataFrame:
    return summaries.agg(
        F.max("run_date").alias("run_date"), F.max_by("summary", "run_date").alias("summary")
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return top.cast("double") / F.nullif(bottom, F.lit(0).cast("bigint"))


def pass_rate(scorecard: DataFrame) -> DataFrame:
    failed, checked = F.sum("records_failed"), F.sum("records_checked")
    return scorecard.agg((1 - _ratio(failed, checked)).alias("pass_rate"))


def open_high(ageing: DataFrame) -> DataFrame:
    return ageing.where("severity = 'HIGH'").agg(F.sum("open_exceptions").alias("open_high"))


def sla_met(control: DataFrame) -> DataFrame:
    return control.agg(_ratio(F.count_if("sla_met"), F.count(F.lit(1))).alias("sla_met_share"))


def failures_by_dimension(scorecard: DataFrame) -> DataFrame:
    return scorecard.groupBy("dimension").agg(F.sum("records_failed").alias("failed"))


def control_trend(control: DataFrame) -> DataFrame:
    """Failures, HIGH failures and missed service levels by day."""
    return control.groupBy("run_date").agg(
        F.sum("failed").alias("failed"),
        F.coalesce(F.sum(F.when(F.col("severity") == "HIGH", F.col("failed"))), F.lit(0)).alias(
            "failed_high"
        ),
        F.count_if(~F.col("sla_met")).alias("sla_breaches"),
    )


def rule_date_matrix(scorecard: DataFrame, days: list[str] | None = None) -> DataFrame:
    """Failures by rule and day, a column per day: the listed days, or all in the scorecard."""
    keyed = scorecard.withColumn("day", F.date_format("run_date", "yyyy-MM-dd"))
    if days is None:
        days = [row.day for row in keyed.select("day").distinct().orderBy("day").collect()]
    return keyed.groupBy("rule_code").pivot("day", days).agg(F.sum("records_failed"))


def top_anomalies(overview: DataFrame, limit: int = 50) -> DataFrame:
    return overview.orderBy(F.desc("anomaly_score"), "txn_id").limit(limit)


def anomalies_by_type(overview: DataFrame) -> DataFrame:
    return (
        overview.where("is_anomaly")
        .groupBy("type")
        .agg(F.count(F.lit(1)).alias("anomalies"), F.avg("anomaly_score").alias("mean_score"))
    )


def score_histogram(overview: DataFrame, bins: int = 20) -> DataFrame:
    """Scores over equal bins of 0 to 1, split by flag."""
    bin_no = F.width_bucket("anomaly_score", F.lit(0.0), F.lit(1.0), F.lit(bins))
    return overview.groupBy(bin_no.alias("bin"), "is_anomaly").agg(
        F.count(F.lit(1)).alias("txn_count")
    )
