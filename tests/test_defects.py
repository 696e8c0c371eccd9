import pytest
from pyspark.sql import functions as F

from ledgerwatch.functions.draws import bucket, draw
from ledgerwatch.operators.catalog import catalog_frame, standard_rules
from ledgerwatch.operators.defects import RATES, draws_for, inject_defects
from ledgerwatch.operators.recall import recall_attributed, recall_literal
from ledgerwatch.plans import testbed as tb
from ledgerwatch.plans.run import run_rules


@pytest.mark.parametrize("seed", [0, 1, 7, 42, 1000])
def test_every_seed_gives_every_rate(spark, seed):
    rates = RATES | {"NULL_AMOUNT": 0.0004, "NEG_AMOUNT": 0.0015}
    count = 200_000
    rows = spark.range(1, count + 1).withColumn("_draw", draw("id", seed))
    for defect, condition in draws_for(rates).items():
        found, wanted = rows.where(condition).count(), rates[defect] * count
        assert abs(found - wanted) <= 4 * wanted**0.5 + 1, defect


def test_rates_and_exclusion(spark):
    conditions = draws_for(RATES)
    hits = spark.range(300_000).withColumn("_draw", draw("id", 5))
    together = sum((F.expr(c).cast("int") for c in conditions.values()), F.lit(0))
    assert hits.where(together > 1).isEmpty()
    with pytest.raises(ValueError):
        draws_for({"NULL_AMOUNT": 0.6, "NEG_AMOUNT": 0.6})
    spread = spark.range(100000).select(bucket("id").alias("b")).groupBy("b").count()
    low, high = spread.agg(F.min("count"), F.max("count")).first()
    assert spread.count() == 1000 and low > 50 and high < 200


def test_large_ids_do_not_overflow(spark):
    assert spark.range(2**62, 2**62 + 5).select(bucket("id")).collect()


def test_copies_may_be_damaged_without_exclusion(spark, sf_dir):
    clean = tb.clean_transactions(spark, sf_dir)
    rates = {"DUP_TXN": 0.5, "NULL_AMOUNT": 0.3}
    damaged, log = inject_defects(clean, draws_for(rates), 3, tb.COPY_OFFSET, exclusive=False)
    copies = damaged.where(f"txn_id >= {tb.COPY_OFFSET}")
    marked = log.where("defect_type = 'DUP_TXN'")
    assert marked.select("txn_id").exceptAll(copies.select("txn_id")).isEmpty()
    assert marked.count() == copies.count() > 0.4 * clean.count()
    escaped = copies.where("amount IS NULL").count()
    assert 0.2 * copies.count() < escaped < 0.4 * copies.count()
    assert damaged.where("amount IS NULL").count() == log.where("defect_type = 'NULL_AMOUNT'").count()


def test_untouched_rows_and_other_seed(spark, sf_dir):
    clean = tb.clean_transactions(spark, sf_dir)
    damaged, log = inject_defects(clean)
    assert damaged.count() == clean.count() + log.where("defect_type = 'DUP_TXN'").count()
    changed = damaged.exceptAll(clean).select("txn_id")
    assert changed.exceptAll(log.select("txn_id")).isEmpty()
    assert damaged.groupBy("txn_id").count().where("count > 1").isEmpty()
    _, other = inject_defects(clean, seed=16807)
    assert other.exceptAll(log).count() > 0


def test_recall(spark, sf_dir):
    _, log = tb.damaged(spark, sf_dir)
    run = run_rules(tb.warehouse(spark, sf_dir), standard_rules(), tb.AS_OF, written=True)
    rows = recall_attributed(log, run.exceptions, catalog_frame(spark, standard_rules())).collect()
    assert sum(r["injected"] for r in rows) == sum(r["caught"] for r in rows) == 16
    literal = recall_literal(log, run.exceptions).collect()
    assert sum(r["injected"] for r in literal) >= 16
