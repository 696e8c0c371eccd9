from datetime import date, datetime, timedelta

from builders import AS_OF
from pyspark.sql import functions as F

from ledgerwatch.operators.catalog import catalog_frame, standard_rules
from ledgerwatch.plans import marts
from ledgerwatch.sources import schemas, tables

LOG = "rule_id int, run_ts timestamp, records_checked bigint, records_failed bigint"


def log_frame(spark, *rows):
    return spark.createDataFrame([(rule, AS_OF, checked, failed) for rule, checked, failed in rows], LOG)


def test_scorecard_and_service_level(spark):
    catalog = catalog_frame(spark, standard_rules())
    log = log_frame(spark, (1, 100, 1), (6, 300, 4), (7, 0, 0), (30, 300, 3))
    card = {r["rule_code"]: r["pass_rate_pct"] for r in marts.rule_scorecard(log, catalog).collect()}
    assert {k: v if v is None else float(v) for k, v in card.items()} == {
        "NULL_AMOUNT": 99.0,
        "NEG_AMOUNT": 98.667,
        "ZERO_AMOUNT": None,
        "ANOMALY_IFOREST": 99.0,
    }
    control = {
        (r["dimension"], r["severity"]): r["sla_met"]
        for r in marts.daily_control(log, catalog).collect()
    }
    assert control == {
        ("Completeness", "HIGH"): True,  # exactly 0.99
        ("Validity", "HIGH"): False,
        ("Validity", "MEDIUM"): None,
        ("Anomaly", "MEDIUM"): True,
    }
    trend = marts.control_trend(marts.daily_control(log, catalog)).first()
    assert (trend["failed"], trend["failed_high"], trend["sla_breaches"]) == (8, 5, 1)


def test_ageing_bounds(spark):
    catalog = catalog_frame(spark, standard_rules())
    second = timedelta(seconds=1)
    ages = [timedelta(0), timedelta(days=1) - second, timedelta(days=1), timedelta(days=7) - second]
    ages += [timedelta(days=7)]
    rows = [(1, i, AS_OF - age, "OPEN") for i, age in enumerate(ages)] + [(1, 9, AS_OF, "RESOLVED")]
    queue = spark.createDataFrame(rows, "rule_id int, txn_id bigint, detected_at timestamp, status string")
    got = {r["age_bucket"]: r["open_exceptions"] for r in marts.exception_ageing(queue, catalog, AS_OF).collect()}
    assert got == {"0-1d": 2, "1-7d": 2, "7d+": 1}


def test_top_rules_and_summary(spark):
    catalog = catalog_frame(spark, standard_rules())
    log = log_frame(spark, *[(rule, 10000, 1200 if rule < 3 else rule) for rule in range(1, 15)])
    old = log.withColumn("run_ts", F.expr("run_ts - INTERVAL '2' DAY"))
    card = marts.rule_scorecard(log.unionByName(old), catalog)
    top = marts.top_failing_rules(card)
    codes = [r["rule_code"] for r in top.collect()]
    assert len(codes) == 10 and codes[:2] == ["NULL_AMOUNT", "NULL_TYPE"]
    text = marts.control_summary(top, date(2026, 1, 20)).first()["summary"].split("\n")
    assert text[0] == "Daily DQ Report - 2026-01-20"
    assert text[1] == "Total exceptions across top rules: 2,484"
    assert text[2].startswith("HIGH severity rules failing: NULL_AMOUNT, NULL_TYPE, BAL_DEST_MISMATCH")
    assert text[3] == (
        "Worst performing rule: NULL_AMOUNT (Completeness) with 1,200 failures (pass rate: 88.0%)"
    )
    assert len(text) == 5
    empty = marts.control_summary(top.where("false"), date(2026, 1, 20)).first()["summary"]
    assert empty == marts.SUMMARY_EMPTY


def test_summary_store(spark, tmp_path):
    path = str(tmp_path / "summaries")
    for day in (20, 21):
        row = spark.createDataFrame([(date(2026, 1, day), f"day {day}")], schemas.SUMMARIES)
        tables.append_table(row, path)
    latest = marts.latest_summary(tables.read_table(spark, path, schemas.SUMMARIES)).first()
    assert tuple(latest) == (date(2026, 1, 21), "day 21")


def test_measures_on_nothing(spark):
    catalog = catalog_frame(spark, standard_rules())
    none = spark.createDataFrame([], LOG)
    assert marts.pass_rate(marts.rule_scorecard(none, catalog)).first()[0] is None
    assert marts.sla_met(marts.daily_control(none, catalog)).first()[0] is None


def test_matrix_days(spark):
    catalog = catalog_frame(spark, standard_rules())
    log = log_frame(spark, (1, 10, 2), (2, 10, 3))
    later = log.withColumn("run_ts", F.lit(datetime(2026, 1, 21)))
    card = marts.rule_scorecard(log.unionByName(later.where("rule_id = 2")), catalog)
    got = {r["rule_code"]: (r["2026-01-20"], r["2026-01-21"]) for r in marts.rule_date_matrix(card).collect()}
    assert got == {"NULL_AMOUNT": (2, None), "NULL_TYPE": (3, 3)}
