import warnings

import pytest
from builders import AS_OF
from pyspark.sql import functions as F

from ledgerwatch.operators import anomaly
from ledgerwatch.operators.staging import stage, stage_with_rejects
from ledgerwatch.plans import testbed as tb
from ledgerwatch.plans.run import reset_store, run_pipeline, store_pipeline
from ledgerwatch.session import dropping_settled, scratch_root
from ledgerwatch.sources.tables import read_feed, read_table

HEADER = "settlement_ref,txn_id,settled_amount,settlement_date"


def test_short_and_long_rows_are_rejected(spark, tmp_path):
    lines = [HEADER, "S1,1,10.00,2026-01-02", "S2,2", "S3,3,1,234.50,2026-01-02", "S4,4,,2026-01-05", "S5,5,x,2026-01-05"]
    (tmp_path / "feed.csv").write_text("\n".join(lines) + "\n")
    raw = read_feed(spark, "settlements", str(tmp_path))
    good, bad = stage_with_rejects(raw, "settlements")
    assert sorted(r["settlement_ref"] for r in good.collect()) == ["S1", "S4"]
    assert sorted(r["settlement_ref"] for r in bad.collect()) == ["S2", "S3", "S5"]
    assert {r["_malformed"] for r in bad.collect()} == {"S2,2", "S3,3,1,234.50,2026-01-02", None}
    with pytest.raises(Exception, match="malformed row"):
        stage(raw.where("settlement_ref <> 'S5'"), "settlements").collect()


def test_header_names_are_checked(spark, tmp_path):
    (tmp_path / "feed.csv").write_text("settlement_ref,amount,txn_id,settlement_date\nS1,1,1,2026-01-02\n")
    with pytest.raises(Exception, match="(?i)header"):
        stage(read_feed(spark, "settlements", str(tmp_path)), "settlements").collect()


def feeds(spark, sf_dir):
    return [tb.as_text(df) for df in (tb.damaged(spark, sf_dir)[0], tb.customer_master(spark, sf_dir), tb.settlements(spark, sf_dir))]


def test_pipeline_stores_and_cleans_up(spark, sf_dir, tmp_path, monkeypatch):
    folder = str(tmp_path / "store")
    used = set()
    monkeypatch.setattr("ledgerwatch.plans.run.score_transactions", lambda wh: 1 / 0)
    with dropping_settled(spark):
        with warnings.catch_warnings(record=True) as seen:
            warnings.simplefilter("always")
            result = run_pipeline(*feeds(spark, sf_dir), AS_OF)
        assert any("anomaly model failed" in str(w.message) for w in seen)
        assert "scores" not in result and "summary" in result
        store_pipeline(result, folder)
        used = set(spark._jvm.java.io.File(scratch_root(spark).replace("file:", "")).list())
    left = set(spark._jvm.java.io.File(scratch_root(spark).replace("file:", "")).list())
    assert left < used
    queued = read_table(spark, f"{folder}/exceptions")
    log = read_table(spark, f"{folder}/rule_run_log")
    assert queued.count() == log.agg(F.sum("records_failed")).first()[0] > 0
    assert read_table(spark, f"{folder}/summaries").count() == 1
    again = run_pipeline(*feeds(spark, sf_dir), AS_OF, queue=queued, with_model=False, with_summary=False)
    assert again["new_exceptions"].isEmpty() and "summary" not in again
    reset_store(spark, folder)
    assert read_table(spark, f"{folder}/exceptions").isEmpty()


def test_a_feed_without_amounts(spark, sf_dir):
    transactions, customers, settlements = feeds(spark, sf_dir)
    nothing = transactions.withColumn("amount", F.lit("")).limit(50)
    result = run_pipeline(nothing, customers, settlements, AS_OF)
    assert result["scores"].isEmpty()
    assert result["rule_run_log"].where("rule_id = 1").first()["records_failed"] == 50
    assert anomaly.features(result["fact"]).isEmpty()
