import random
from datetime import date, datetime

import pytest
from builders import AS_OF, MASTER, make_warehouse, staged_frame

from ledgerwatch.functions.expressions import event_time
from ledgerwatch.functions.lookups import Limits
from ledgerwatch.operators.catalog import standard_rules
from ledgerwatch.operators.delta import DeltaStore
from ledgerwatch.operators.rules import failing
from ledgerwatch.session import settle

RULES = standard_rules()


def pairs(frame):
    return {(r.rule_id, r.txn_id) for r in frame.collect()}


def busy_rows(rng, n):
    """Few accounts, keys, hours and amounts, so that rows meet each other in every rule."""
    rows = []
    for k in rng.sample(range(5 * n), n):
        dest = rng.choice(["C1", "C2", "M1", "C9", None])
        amount = rng.choice(["10.00", "20.00", "5000000.00", None, "0.07"])
        step = rng.choice([0, 1, 22, 23, 24, 25, 26, 47, 48, 500, None])
        rows.append((k, step, rng.choice(["DEBIT", "PAYMENT", None]), amount, rng.choice(["C1", "C3", "C8"]), "50.00", "40.00", dest, "0.00", "10.00"))
    return rows


def feeds(spark, rng, n=160):
    rows = busy_rows(rng, n)
    ids = [r[0] for r in rows]
    settled = [
        (f"S{rng.randrange(n)}", rng.choice([*ids, *ids, *ids, 10**6, None]), rng.choice(["10.00", "20.00", None]), date(2026, 1, rng.randint(1, 6)))
        for _ in range(n)
    ]
    master = [(f"C{k}", "A", "VERIFIED", "X", date(2020, 1, 1)) for k in (1, 2, 3, 3, 8) for _ in range(rng.randint(0, 2))]
    return rows, settled, master


@pytest.mark.parametrize("hours", [1, 24])
def test_equals_a_run_on_all_history_after_every_cut(spark, tmp_path, hours):
    rng = random.Random(hours)
    rows, settled, master = feeds(spark, rng)
    store = DeltaStore(spark, str(tmp_path / "delta"), RULES, hours=hours)
    cuts = 3
    for k in range(cuts):
        fresh = make_warehouse(spark, rows[k::cuts], master[k::cuts], settled[k::cuts])
        fact, paid, customers = (settle(x)[0] for x in (fresh.fact, fresh.settlements, fresh.customer_master))
        store.apply(k, AS_OF, fact, paid, customers)
        so_far = [sum((x[j::cuts] for j in range(k + 1)), []) for x in (rows, master, settled)]
        assert pairs(store.failing()) == pairs(failing(make_warehouse(spark, *so_far), RULES, AS_OF))


def test_findings_that_are_not_broadcast(spark, tmp_path):
    rows, settled, master = feeds(spark, random.Random(3), 60)
    store = DeltaStore(spark, str(tmp_path / "delta"), RULES, Limits(rows=0, hot_keys=1, hot_rows=2))
    for k in range(2):
        fresh = make_warehouse(spark, rows[k::2], master[k::2], settled[k::2])
        store.apply(k, AS_OF, *(settle(x)[0] for x in (fresh.fact, fresh.settlements, fresh.customer_master)))
    assert pairs(store.failing()) == pairs(failing(make_warehouse(spark, rows, master, settled), RULES, AS_OF))


def test_feeds_by_themselves_and_time_that_moves(spark, tmp_path):
    store = DeltaStore(spark, str(tmp_path / "delta"), RULES)
    code = {rule.rule_code: rule.rule_id for rule in RULES}
    fact = staged_frame(spark, [(1, 30, "DEBIT", "10.00", "C1", "50.00", "40.00", "C2", "0.00", "10.00")]).withColumn("txn_ts", event_time())
    fact, _ = settle(fact.select("txn_id", "step", "txn_ts", *[c for c in fact.columns if c not in ("txn_id", "step", "txn_ts")]))
    early = datetime(2026, 1, 2, 5)
    store.apply(0, early, fact)
    assert pairs(store.failing()) == {(code[c], 1) for c in ("ORPHAN_ORIG", "ORPHAN_DEST", "SETTLEMENT_MISSING", "FUTURE_DATED")}
    changes = store.apply(1, AS_OF)  # only time has passed
    assert [tuple(r) for r in changes.collect()] == [(code["FUTURE_DATED"], 1, False)]
    master, _ = settle(spark.createDataFrame([("C1", "A", "V", "X", date(2020, 1, 1))] * 2, MASTER))
    store.apply(2, AS_OF, customer_master=master)
    assert pairs(store.failing()) == {(code[c], 1) for c in ("ORPHAN_DEST", "SETTLEMENT_MISSING", "DUP_CUSTOMER_MASTER")}
    paid, _ = settle(make_warehouse(spark, [], [], [("S1", 1, "11.00", date(2026, 1, 9))]).settlements)
    store.apply(3, AS_OF, settlements=paid)
    assert pairs(store.failing()) == {
        (code[c], 1) for c in ("ORPHAN_DEST", "DUP_CUSTOMER_MASTER", "SETTLEMENT_AMOUNT_DIFF", "LATE_SETTLEMENT")
    }


def test_a_day_reads_and_writes_its_own_parts(spark, tmp_path):
    """A run on one day opens the state of that day and its neighbours only."""
    store = DeltaStore(spark, str(tmp_path / "delta"), RULES)
    rows = [(k, 24 * (k % 20), "DEBIT", "10.00", "C1", "50.00", "40.00", "C2", "0.00", "10.00") for k in range(200)]
    store.apply(0, AS_OF, settle(make_warehouse(spark, rows).fact)[0])
    one = store.tables["copies"].read([19])
    one.collect()
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == len(list((tmp_path / "delta" / "copies" / "part=19").glob("*.parquet")))
    before = {f.name for f in (tmp_path / "delta" / "copies" / "part=3").iterdir()}
    late = [(900, 24 * 19, "DEBIT", "10.00", "C1", "50.00", "40.00", "C2", "0.00", "10.00")]
    changes = store.apply(1, AS_OF, settle(make_warehouse(spark, late).fact)[0])
    assert {f.name for f in (tmp_path / "delta" / "copies" / "part=3").iterdir()} == before
    code = {rule.rule_code: rule.rule_id for rule in RULES}
    assert (code["DUP_BUSINESS_KEY"], 900) in pairs(changes)
    assert pairs(store.failing()) == pairs(failing(make_warehouse(spark, rows + late), RULES, AS_OF))


def test_queries_and_models_are_refused(spark, tmp_path):
    from ledgerwatch.operators.catalog import set_active

    with pytest.raises(ValueError, match="ANOMALY_IFOREST"):
        DeltaStore(spark, str(tmp_path / "delta"), set_active(RULES, "ANOMALY_IFOREST"))


def files_read(frame):
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().apply(0).metrics().apply("numFiles").value()


def test_a_run_opens_the_files_of_its_own_cut(spark, tmp_path, monkeypatch):
    from ledgerwatch.plans import queries

    orders = [(k, k % 9, 10.0 * k) for k in range(200)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k, 0, "A") for k in range(9)], "c_custkey bigint, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(0, "X")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    seen = {"fact": [], "paid": []}

    def apply(self, run, as_of, fact, settlements, customer_master):
        for name, frame in (("fact", fact), ("paid", settlements)):
            seen[name].append((frame.count(), files_read(frame), len(frame.inputFiles())))

    monkeypatch.setattr(queries.DeltaStore, "apply", apply)
    queries.exceptions_by_delta(spark, str(tmp_path))
    wh = queries.tb.warehouse(spark, str(tmp_path))
    for name, rows in (("fact", wh.fact), ("paid", wh.settlements)):
        counts, opened, files = zip(*seen[name])
        assert sum(counts) == rows.count()
        assert sum(opened) == files[0]


def test_account_verdicts_pass_over_the_rows_once(spark, tmp_path):
    store = DeltaStore(spark, str(tmp_path / "delta"), RULES)
    rows = spark.createDataFrame([(1, True, False), (2, True, True), (3, False, None), (None, None, True)], "txn_id bigint, a boolean, b boolean")
    found = store._verdicts(rows, {"A": 7, "B": 8, "C": 9}, {"A": ("a", True), "B": ("a AND NOT b", False), "D": ("b", True)})
    assert {tuple(r) for r in found.collect()} == {(7, 1, True), (7, 2, True), (8, 1, False)}
