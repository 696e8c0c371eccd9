from datetime import date, datetime

import pytest
from builders import MASTER, staged_frame

from ledgerwatch.operators import warehouse as dw
from ledgerwatch.plans import testbed as tb
from ledgerwatch.plans.run import run_pipeline
from ledgerwatch.sources import tables


def test_dim_customer_takes_one_whole_row(spark):
    rows = [
        ("C1", "b", "x", "US", date(2020, 1, 1)),
        ("C1", "a", "z", "UK", date(2021, 1, 1)),
        ("C2", None, "x", "US", None),
    ]
    got = sorted(map(tuple, dw.dim_customer(spark.createDataFrame(rows, MASTER)).collect()))
    assert got == [("C1", "a", "z", "UK", date(2021, 1, 1)), ("C2", None, "x", "US", None)]


def test_dim_time_fields(spark):
    rows = [(i, step, "DEBIT", 1, "C1", 1, 0, "C2", 0, 1) for i, step in enumerate((0, 0, -1, 77))]
    got = {r["time_key"]: tuple(r)[1:] for r in dw.dim_time(staged_frame(spark, rows)).collect()}
    assert got == {
        0: (datetime(2026, 1, 1), 0, 4, 1, 1),  # a Thursday
        -1: (datetime(2025, 12, 31, 23), 23, 3, 1, 12),
        77: (datetime(2026, 1, 4, 5), 5, 0, 1, 1),  # a Sunday
    }


def test_txn_types_are_added_only_if_absent(spark):
    have = spark.createDataFrame([(7, "DEBIT", "OTHER")], "type_id int, type string, direction string")
    got = {r["type"]: r["direction"] for r in dw.dim_txn_type(spark, have).collect()}
    assert len(got) == 5 and got["DEBIT"] == "OTHER" and got["CASH_IN"] == "CREDIT"


def test_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k bigint")
    assert sorted(map(tuple, dw.key_violations(df, "k", "t").collect()), key=str) == [
        ("t", "1", 2),
        ("t", None, 1),
    ]
    with pytest.raises(ValueError):
        dw.require_key(df, "k", "t")
    assert dw.require_key(df.where("k = 2"), "k", "t").count() == 1


def test_account_universe(spark):
    rows = [(1, 1, "DEBIT", 1, "C1", 1, 0, "M1", 0, 1), (2, 1, "DEBIT", 1, "C2", 1, 0, "C1", 0, 1)]
    got = dw.account_universe(staged_frame(spark, rows)).collect()
    assert sorted(r[0] for r in got) == ["C1", "C2"]


def test_lookup_layout_prunes_files(spark, sf_dir, tmp_path):
    fact = tb.warehouse(spark, sf_dir).fact
    path = str(tmp_path / "fact")
    tables.write_lookup_layout(fact, path, files=6)
    laid = spark.read.parquet(path)
    dest = fact.where("name_dest IS NOT NULL").first()["name_dest"]
    want = sorted(map(tuple, tables.destination_counts(fact, dest, 0, 744).collect()))
    got = tables.destination_counts(laid, dest, 0, 744)
    assert sorted(map(tuple, got.collect())) == want and want
    scan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in scan and f"EqualTo(name_dest,{dest})" in scan
    holding = laid.where(laid["name_dest"] == dest).selectExpr("input_file_name() AS f").distinct()
    assert holding.count() <= 2


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "OPEN")], "id int, status string")
    tables.replace_table(one, path, ("status",))
    tables.append_table(one.selectExpr("2 AS id", "'RESOLVED' AS status"), path, ("status",))
    back = tables.read_table(spark, path, "id int, status string")
    assert [r["id"] for r in tables.open_rows(back).collect()] == [1] and back.count() == 2
    tables.replace_table(one, path)
    assert tables.read_table(spark, path).count() == 1


def test_pipeline_keeps_history_unless_reset(spark, sf_dir):
    feeds = [
        tb.as_text(df)
        for df in (
            tb.damaged(spark, sf_dir)[0],
            tb.customer_master(spark, sf_dir),
            tb.settlements(spark, sf_dir),
        )
    ]
    first = run_pipeline(*feeds, as_of=tb.AS_OF)
    assert first["rule_run_log"].count() == 30
    queued = first["exceptions"].count()
    assert queued == 782 + first["scores"].where("is_anomaly").count()
    assert first["anomaly_overview"].count() == first["scores"].count()
    assert "HIGH severity rules failing" in first["summary"].first()["summary"]
    second = run_pipeline(
        *feeds, as_of=datetime(2026, 1, 21), queue=first["exceptions"], history=first["rule_run_log"]
    )
    # a day later some transactions are no longer in the future; nothing new is wrong
    assert second["new_exceptions"].isEmpty()
    assert second["exceptions"].count() == queued and second["rule_run_log"].count() == 60
    again = run_pipeline(*feeds, as_of=tb.AS_OF, queue=first["exceptions"], reset=True)
    assert again["new_exceptions"].count() == queued and again["rule_run_log"].count() == 30
