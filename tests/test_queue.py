import random
from datetime import datetime, timedelta, timezone

from builders import AS_OF, make_warehouse
from test_rules import TEN

from ledgerwatch.operators.catalog import catalog_frame, standard_rules
from ledgerwatch.operators.queue import apply_updates, mark_new, new_exceptions, run_log
from ledgerwatch.operators.warehouse import catalog_violations
from ledgerwatch.plans import testbed as tb
from ledgerwatch.plans.run import run_rules

RULES = standard_rules()


def pairs(df):
    return sorted(map(tuple, df.select("rule_id", "txn_id").collect()), key=str)


def test_second_run_inserts_nothing(spark, sf_dir):
    wh = tb.warehouse(spark, sf_dir)
    first = run_rules(wh, RULES, AS_OF, written=True)
    assert first.exceptions.count() == 782
    later = run_rules(wh, RULES, AS_OF, run_ts=datetime(2026, 1, 21), queue=first.exceptions)
    assert later.exceptions.isEmpty()
    log = {r["rule_id"]: r for r in later.log.collect()}
    assert len(log) == 29
    assert all(r["records_failed"] == 0 and r["records_checked"] == 1503 for r in log.values())
    assert sum(r["records_failing"] for r in log.values()) == 782


def test_log_has_a_row_for_every_active_rule(spark):
    run = run_rules(make_warehouse(spark, TEN), RULES, AS_OF)
    log = {r["rule_id"]: r for r in run.log.collect()}
    assert sorted(log) == [r.rule_id for r in RULES if r.active]
    assert {r["records_checked"] for r in log.values()} == {10}
    assert log[6]["records_failed"] == 1 and log[9]["records_failed"] == 0


def test_no_active_rule_and_empty_fact(spark):
    run = run_rules(make_warehouse(spark, TEN), [], AS_OF)
    assert run.exceptions.isEmpty() and run.log.isEmpty()
    empty = run_rules(make_warehouse(spark, []), RULES, AS_OF)
    assert empty.exceptions.isEmpty()
    assert {tuple(r)[3:] for r in empty.log.collect()} == {(0, 0, 0)}


def test_null_ids_are_one_value(spark):
    hits = spark.createDataFrame([(21, None), (21, 5), (21, None)], "rule_id int, txn_id bigint")
    queue = spark.createDataFrame([(21, None), (3, 5)], "rule_id int, txn_id bigint")
    marked = {(r["rule_id"], r["txn_id"]): r["is_new"] for r in mark_new(hits, queue).collect()}
    assert marked == {(21, None): False, (21, 5): True}


def test_exception_defaults(spark):
    hits = spark.createDataFrame([(1, 5)], "rule_id int, txn_id bigint")
    row = new_exceptions(mark_new(hits, None), AS_OF).first()
    assert (row["status"], row["assigned_to"], row["resolved_at"], row["note"]) == ("OPEN", None, None, None)
    assert row["detected_at"] == AS_OF and row["exception_id"] is not None
    log = run_log(mark_new(hits, None), hits, RULES, AS_OF)
    assert log.where("rule_id = 1").first()["records_failed"] == 1


def test_lifecycle(spark):
    hits = spark.createDataFrame([(1, i) for i in range(6)] + [(21, None)], "rule_id int, txn_id bigint")
    queue = new_exceptions(mark_new(hits, None), AS_OF)
    t1, t2, t3 = (datetime(2026, 1, day) for day in (21, 22, 23))
    schema = (
        "rule_id int, txn_id bigint, status string, assigned_to string, note string, updated_at timestamp"
    )
    first = spark.createDataFrame(
        [
            (1, 0, "ASSIGNED", "ann", None, t1),
            (1, 1, "ASSIGNED", "ann", None, t1),
            (1, 1, "RESOLVED", "bob", "fixed", t2),  # the later owner counts
            (1, 2, "RESOLVED", None, "fixed", t2),
            (1, 2, "ASSIGNED", "ann", None, t1),
            (21, None, "ASSIGNED", "cat", None, t1),
            (9, 9, "RESOLVED", "cat", None, t1),  # not in the queue
        ],
        schema,
    )
    second = spark.createDataFrame(
        [
            (1, 0, "OPEN", None, "back", t3),
            (1, 1, "ASSIGNED", "dan", None, t3),
            (1, 1, "OPEN", "dan", None, t2),
        ],
        schema,
    )
    result = apply_updates(apply_updates(queue, first), second)
    assert result.columns == queue.columns and result.count() == queue.count()
    rows = {(r["rule_id"], r["txn_id"]): r for r in result.collect()}

    def state(rule, txn):
        row = rows[rule, txn]
        return row["status"], row["assigned_to"], row["resolved_at"], row["note"]

    assert state(1, 0) == ("ASSIGNED", "ann", None, None)
    assert state(1, 1) == ("RESOLVED", "bob", t2, "fixed")
    assert state(1, 2) == ("RESOLVED", "ann", t2, "fixed")  # taken up before it was closed
    assert state(1, 3) == ("OPEN", None, None, None)
    assert state(21, None) == ("ASSIGNED", "cat", None, None)


def test_any_split_into_batches_gives_one_result(spark):
    hits = spark.createDataFrame([(1, i) for i in range(40)], "rule_id int, txn_id bigint")
    queue = new_exceptions(mark_new(hits, None), AS_OF)
    rng = random.Random(4)
    updates = [
        (1, i, rng.choice(["OPEN", "ASSIGNED", "RESOLVED", "ASSIGNED", "LOST"]), rng.choice([None, "ann", "bob"]),
         rng.choice([None, "a note", "b note"]), datetime(2026, 1, 21, hour))
        for i in range(40) for hour in rng.sample(range(24), rng.randint(0, 6))
    ]
    schema = (
        "rule_id int, txn_id bigint, status string, assigned_to string, note string, updated_at timestamp"
    )

    def after(*hours):
        worked = queue
        for low, high in zip((0, *hours), (*hours, 24)):
            batch = [u for u in updates if low <= u[5].hour < high]
            rng.shuffle(batch)
            worked = apply_updates(worked, spark.createDataFrame(batch, schema))
        return sorted(tuple(r) for r in worked.drop("exception_id").collect())

    def key(rows):
        return [tuple(str(v) for v in r) for r in rows]

    def in_turn(txn):
        order = ["OPEN", "ASSIGNED", "RESOLVED"]
        status, owner, closed, note = "OPEN", None, None, None
        for _, _, to, who, text, at in sorted((u for u in updates if u[1] == txn), key=lambda u: u[5]):
            if to in order and order.index(to) >= order.index(status):
                closed = at if to == "RESOLVED" and status != "RESOLVED" else closed
                status, owner, note = to, who or owner, text or note
        return status, owner, closed, note

    whole = key(after())
    assert whole == key(after(12)) == key(after(5, 11, 19))
    for row in whole:
        assert row[3:] == tuple(str(v) for v in in_turn(int(row[1])))


def test_first_run_folds_repeats_and_times_with_zones(spark):
    hits = spark.createDataFrame([(1, 5), (1, 5), (2, None), (2, None)], "rule_id int, txn_id bigint")
    aware = datetime(2026, 1, 20, 3, tzinfo=timezone(timedelta(hours=5)))
    rows = new_exceptions(mark_new(hits, None), aware).collect()
    assert sorted((r["rule_id"], r["txn_id"]) for r in rows) == [(1, 5), (2, None)]
    assert {r["detected_at"] for r in rows} == {datetime(2026, 1, 19, 22)}


def test_catalog_checks(spark):
    catalog = catalog_frame(spark, RULES)
    queue = spark.createDataFrame([(1, 5), (99, 5)], "rule_id int, txn_id bigint")
    found = [tuple(r) for r in catalog_violations(catalog, queue).collect()]
    assert found == [("rule_id", "99")]
    assert pairs(queue) == [(1, 5), (99, 5)]
