import random
from datetime import datetime
from pathlib import Path

from ledgerwatch.operators.queue import apply_updates, mark_new, new_exceptions
from ledgerwatch.operators.queue_store import QueueStore

PAIR = "rule_id int, txn_id bigint"
UPDATE = "rule_id int, txn_id bigint, status string, assigned_to string, note string, updated_at timestamp"
MONDAY, TUESDAY = datetime(2026, 1, 19), datetime(2026, 1, 20)


def files(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def test_second_run_queues_what_is_new(spark, tmp_path):
    store = QueueStore.at(spark, str(tmp_path), 1000)
    edge = [0, -1, -7, 1, 32767, 32768, 32769, 10**15 + 5, None]
    first = [(1, i) for i in range(0, 3000, 3)] + [(21, i) for i in edge] + [(1, 0)]
    second = [(1, i) for i in range(0, 3000, 2)] + [(21, i) for i in edge] + [(22, i) for i in edge] + [(21, 2), (21, -2)]
    one = store.insert(spark.createDataFrame(first, PAIR), MONDAY)
    assert one.where("NOT is_new").isEmpty() and one.count() == len(set(first))
    two = {(r.rule_id, r.txn_id): r.is_new for r in store.insert(spark.createDataFrame(second, PAIR), TUESDAY).collect()}
    assert two == {p: p not in set(first) for p in second}
    rows = store.read().collect()
    assert {(r.rule_id, r.txn_id): r.detected_at for r in rows} == {p: MONDAY if p in set(first) else TUESDAY for p in first + second}
    assert len(rows) == len(set(first + second))
    # the same marks as the aggregate over the whole queue gives
    third = spark.createDataFrame([(1, i) for i in range(50)] + [(5, None)], PAIR)
    assert sorted(map(tuple, store.mark(third).collect()), key=str) == sorted(map(tuple, mark_new(third, store.read()).collect()), key=str)


def test_a_run_opens_bitmaps_of_its_bands_and_no_items(spark, tmp_path):
    store = QueueStore.at(spark, str(tmp_path), 1000)
    store.insert(spark.createDataFrame([(1, i) for i in range(0, 20_000, 7)], PAIR), MONDAY)
    findings = spark.createDataFrame([(1, i) for i in range(19_000, 20_000)], PAIR)
    marked = store.mark(findings)
    opened = [f for f in marked.inputFiles() if str(tmp_path) in f]
    assert not [f for f in opened if "/items/" in f]
    pruned = store.bits.read([19])
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(band" in plan
    scanned = pruned._jdf.queryExecution().executedPlan()
    pruned.collect()
    scan = scanned.collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == len(list((tmp_path / "bits" / "band=19").glob("*.parquet")))
    assert len(list((tmp_path / "bits").glob("band=*"))) == 20


def test_an_update_rewrites_the_bands_it_touches(spark, tmp_path):
    store = QueueStore.at(spark, str(tmp_path), 1000)
    found = spark.createDataFrame([(r, i) for r in (1, 2) for i in range(0, 5000, 10)] + [(21, None)], PAIR)
    store.insert(found, MONDAY)
    queue = new_exceptions(mark_new(found, None), MONDAY)
    rng = random.Random(5)
    sent = [
        (rng.choice((1, 2)), rng.randrange(0, 2000, 10), rng.choice(("OPEN", "ASSIGNED", "RESOLVED")), rng.choice(("ann", None)), None, datetime(2026, 1, 20, h))
        for h in range(24)
    ]
    sent += [(1, i, "RESOLVED", None, "done", TUESDAY) for i in range(4000, 5000, 10)]
    sent += [(2, i, "RESOLVED", None, "done", TUESDAY) for i in range(4000, 5000, 10)] + [(9, 9, "RESOLVED", None, None, TUESDAY)]
    updates = spark.createDataFrame(sent, UPDATE)
    before = files(tmp_path / "items")
    store.update(updates)
    after = files(tmp_path / "items")
    kept = {f for f, t in before.items() if after.get(f) == t}
    assert kept == {f for f in before if f.startswith(("band=2/", "band=3/", "band=-"))}
    want = apply_updates(queue, updates)
    assert sorted(map(str, store.read().collect())) == sorted(map(str, want.select(store.read().columns).collect()))
    # all of the last band is closed: its open part holds no item any more
    assert store.items.read([4]).where("status = 'OPEN' AND exception_id IS NOT NULL").isEmpty()
    assert sorted(map(tuple, store.open_items().select("rule_id", "txn_id").collect()), key=str) == sorted(
        map(tuple, want.where("status = 'OPEN'").select("rule_id", "txn_id").collect()), key=str
    )
    # a second batch finds the blank rows of the first in its way
    store.update(spark.createDataFrame([(1, 4000, "OPEN", "bob", None, TUESDAY)], UPDATE))
    assert store.read().count() == queue.count()


def test_empty_findings_and_updates(spark, tmp_path):
    store = QueueStore.at(spark, str(tmp_path))
    assert store.insert(spark.createDataFrame([], PAIR), MONDAY).isEmpty() and store.read().isEmpty()
    store.update(spark.createDataFrame([], UPDATE))
    store.insert(spark.createDataFrame([(1, 1)], PAIR), MONDAY)
    store.update(spark.createDataFrame([], UPDATE))
    assert QueueStore.at(spark, str(tmp_path)).open_items().count() == 1
