from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators.staging import (
    stage,
    stage_transactions,
    stage_with_rejects,
    with_row_ids,
)
from ledgerwatch.operators import staging
from ledgerwatch.plans import testbed as tb
from ledgerwatch.sources.tables import read_feed, write_feed

TEXT = "settlement_ref string, txn_id string, settled_amount string, settlement_date string"


def test_empty_text_is_null_and_money_rounds_half_up(spark):
    raw = spark.createDataFrame([("S1", "7", "181.005", "2026-01-05"), ("", "", "", "")], TEXT)
    assert [tuple(r) for r in stage(raw, "settlements").collect()] == [
        ("S1", 7, Decimal("181.01"), date(2026, 1, 5)),
        (None, None, None, None),
    ]


def test_bad_text_fails_or_is_rejected(spark):
    raw = spark.createDataFrame(
        [("S1", "7", "1.00", "2026-01-05"), ("S2", "x", "1.00", ""), ("S3", "", "1,5", "")], TEXT
    )
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        stage(raw, "settlements").collect()
    good, bad = stage_with_rejects(raw, "settlements")
    assert [r["settlement_ref"] for r in good.collect()] == ["S1"]
    assert sorted(tuple(r) for r in bad.collect()) == [("S2", "x", "1.00", ""), ("S3", "", "1,5", "")]


def test_feed_through_csv(spark, sf_dir, tmp_path):
    staged = tb.damaged(spark, sf_dir)[0]
    path = str(tmp_path / "transactions")
    write_feed(tb.as_text(staged), path)
    back = stage_transactions(read_feed(spark, "transactions", path, keyed=True))
    assert back.schema.simpleString() == staged.schema.simpleString()
    assert back.exceptAll(staged).isEmpty() and staged.exceptAll(back).isEmpty()


def test_row_ids_are_dense_and_ignore_layout(spark, monkeypatch):
    monkeypatch.setattr(staging, "COPIES_PER_ROW", 7)  # force copies over several runs
    rows = spark.range(1000).selectExpr(
        "IF(id % 3 = 0, 0, id) AS a", "IF(id % 50 = 1, NULL, concat('x', id % 3)) AS b"
    )
    ids = with_row_ids(rows, ["a", "b"])
    again = with_row_ids(rows.repartition(13), ["a", "b"])
    assert ids.agg(F.min("txn_id"), F.max("txn_id"), F.countDistinct("txn_id")).first() == (1, 1000, 1000)
    assert ids.drop("txn_id").exceptAll(rows).isEmpty()
    assert ids.exceptAll(again).isEmpty() and again.count() == 1000
