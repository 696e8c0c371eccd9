"""Every rule on hand-made rows, with exact sets, and the same results by every join route."""

import random
from datetime import date

import pytest
from builders import AS_OF, make_warehouse

from ledgerwatch.functions.lookups import Limits
from ledgerwatch.operators.catalog import add_rule, set_active, standard_rules
from ledgerwatch.operators.rules import failing, failing_rule
from ledgerwatch.plans import testbed as tb

RULES = standard_rules()

# The ten-row fixture (FIXTURES.md, section 2).
TEN = [
    (1, 1, "PAYMENT", 1000, "C100", 5000, 4000, "M200", 0, 1000),
    (2, 2, "TRANSFER", None, "C101", 3000, 3000, "C102", 0, 0),
    (3, 3, "CASH_OUT", -500, "C103", 2000, 2500, "C104", 0, 500),
    (4, 1, "PAYMENT", 1000, "C100", 5000, 4000, "M200", 0, 1000),
    (5, 5, "DEBIT", 200, "INVALID_999", 1000, 800, "C106", 0, 200),
    (6, 6, "CASH_OUT", 100, "C107", 1000, 500, "C108", 0, 100),
    (7, 7, "TRANSFER", 300, "C109", 1000, 700, "C109", 0, 300),
    (8, 8, "PAYMENT", 400, "C110", 2000, 1600, "C111", 0, 400),
    (9, 9, "WIRE", 250, "C112", 1000, 750, "C113", 0, 250),
    (10, 10, "TRANSFER", 0, "C114", 1000, 1000, "C115", 0, 0),
]
TEN_EXPECTED = {
    "NULL_AMOUNT": {2},
    "NEG_AMOUNT": {3},
    "ZERO_AMOUNT": {10},
    "INVALID_TYPE": {9},
    "BAD_ACCT_FORMAT": {5},
    "SELF_TRANSFER": {7},
    "PAYMENT_DEST_NOT_MERCHANT": {8},
    "DUP_BUSINESS_KEY": {4},
    "BAL_ORIG_MISMATCH": {6},
    "BAL_DEST_MISMATCH": {3},
}
FACT_ONLY = [r.rule_code for r in RULES if r.kind in ("row", "copies", "outlier", "velocity")]


def by_code(hits, rules=RULES):
    names = {r.rule_id: r.rule_code for r in rules}
    found = {}
    for row in hits.collect():
        found.setdefault(names[row["rule_id"]], []).append(row["txn_id"])
    assert all(len(ids) == len(set(ids)) for ids in found.values()), "a pair came twice"
    return {code: set(ids) for code, ids in found.items()}


def test_ten_rows_exact(spark):
    wh = make_warehouse(spark, TEN)
    chosen = [r for r in RULES if r.rule_code in FACT_ONLY]
    assert by_code(failing(wh, chosen, AS_OF)) == TEN_EXPECTED


def test_limits_are_strict(spark):
    rows = [
        (1, 744, "DEBIT", "100.00", "C1", 500, "400.01", "C2", 0, 100),  # off by 0.01: fine
        (2, 745, "DEBIT", "100.00", "C1", 500, "400.02", "C2", 0, 100),
        (3, 0, "DEBIT", 10000000, "C1", 10000000, 0, "C2", 0, 10000000),
        (4, 0, "DEBIT", "10000000.01", "C1", "10000000.01", 0, "C2", 0, "10000000.01"),
        (5, 0, "TRANSFER", 200000, "C1", 200000, 0, "C2", 0, 200000),
        (6, 0, "TRANSFER", "200000.01", "C1", "200000.01", 0, "C2", 0, "200000.01"),
        (7, 0, "TRANSFER", 300000, "C1", 300000, 0, "C2", 0, 300000, 0, 1),
        (8, -1, "CASH_IN", 10, "C1", 0, 10, "C2", 10, 0),
    ]
    found = by_code(failing(make_warehouse(spark, rows), [r for r in RULES if r.kind == "row"], AS_OF))
    assert found == {
        "BAL_ORIG_MISMATCH": {2},
        "STEP_OUT_OF_RANGE": {2, 8},
        "AMOUNT_OVER_LIMIT": {4},
        "FLAG_RULE_MISMATCH": {6},
        "FUTURE_DATED": {1, 2},
    }


def test_null_operands_flag_nothing_else(spark):
    rows = [
        (1, 1, None, 100, "C1", 500, 400, "C2", 0, 100),  # a NULL type counts as not CASH_IN
        (2, 1, None, 100, "C1", 500, 600, "C2", 0, 100),
        (3, 1, "DEBIT", 100, "C1\n", 500, 400, "M2", 0, 100),
        (4, 1, "DEBIT", 100, "X1", 500, 400, None, 0, 100),
        (5, 1, "DEBIT", 100, "C1", None, 400, "C2", 0, 100),
        (6, 1, "PAYMENT", 100, None, 500, 400, None, 0, 900),
    ]
    found = by_code(failing(make_warehouse(spark, rows), [r for r in RULES if r.kind == "row"], AS_OF))
    assert found == {
        "NULL_TYPE": {1, 2},
        "NULL_ORIG_ACCT": {6},
        "NULL_DEST_ACCT": {4, 6},
        "NULL_BALANCE_FIELDS": {5},
        "BAD_ACCT_FORMAT": {3, 4},
        "BAL_ORIG_MISMATCH": {2},
    }


ROUTES = {
    "broadcast": Limits(),
    "shuffled": Limits(rows=0),
    "split": Limits(rows=0, hot_rows=2, hot_keys=2),
}


@pytest.mark.parametrize("route", ROUTES)
def test_rules_across_rows(spark, route):
    day = date(2026, 1, 1)
    rows = [(i, 1, "DEBIT", i, "C1", 100, 100 - i, "M1", 0, i) for i in range(1, 4)]
    rows += [
        (10, 1, "DEBIT", 5, "C2", 5, 0, "C3", 0, 5),
        (11, 1, "DEBIT", 6, "C9", 6, 0, "C1", 0, 6),
        (12, 1, "DEBIT", 7, "C1", 7, 0, "C8", 0, 7),
        (13, 1, "DEBIT", 8, None, 8, 0, "X8", 0, 8),
        (20, 2, None, None, None, 8, 0, None, 0, 8),
        (21, 2, None, None, None, 9, 0, None, 0, 8),
        (22, 2, None, None, None, 9, 0, None, 0, 8),
    ]
    master = [("C1", "a", "b", "c", day), ("C2", "a", "b", "c", day), ("C2", "a", "b", "c", day)]
    master += [("C3", "a", "b", "c", day)]
    settled = [
        ("S1", 1, 1, date(2026, 1, 3)),  # T+2 is in time
        ("S1", 2, 3, date(2026, 1, 4)),  # late, differs, second use of S1
        (None, 3, 3, day),
        (None, 10, 5, day),
        ("S2", None, 5, day),
        ("S2", None, 5, day),
        ("S3", 11, 6, day),
        ("S3", 11, 7, day),  # same reference and transaction, and one amount differs
        ("S4", 12, None, None),
        ("S5", 20, 1, day),
    ]
    wh = make_warehouse(spark, rows, master, settled)
    kinds = ("account", "copies", "reference", "settlement")
    chosen = [r for r in RULES if r.kind in kinds]
    assert by_code(failing(wh, chosen, AS_OF, ROUTES[route])) == {
        "DUP_CUSTOMER_MASTER": {10},
        "ORPHAN_ORIG": {11},
        "ORPHAN_DEST": {12},
        "DUP_BUSINESS_KEY": {21, 22},
        "DUP_SETTLEMENT_REF": {2, 10, None, 11},
        "SETTLEMENT_MISSING": {13, 21, 22},
        "SETTLEMENT_AMOUNT_DIFF": {2, 11},
        "LATE_SETTLEMENT": {2},
    }


@pytest.mark.parametrize("route", ROUTES)
def test_velocity_frame(spark, route):
    def arrivals(first, count, step, dest):
        return [(first + i, step, "DEBIT", 1, "C1", 1, 0, dest, 0, 1) for i in range(count)]

    rows = arrivals(100, 10, 5, "C10")  # ten: fine
    rows += arrivals(200, 11, 5, "C11")
    rows += arrivals(300, 10, 5, "C12") + arrivals(350, 1, 8, "C12")  # eleventh three hours on
    rows += arrivals(400, 10, 5, "C13") + arrivals(450, 1, 9, "C13")  # four hours on: fine
    rows += arrivals(500, 10, 1022, "C14") + arrivals(550, 1, 1025, "C14")  # over a block edge
    rows += arrivals(600, 11, None, "C15")  # hours not given are peers
    rows += arrivals(700, 11, 7, None)  # so are destinations
    rows += arrivals(800, 10, -2, "C16") + arrivals(850, 1, 1, "C16")
    rule = [r for r in RULES if r.rule_code == "DEST_VELOCITY"]
    found = by_code(failing(make_warehouse(spark, rows), rule, AS_OF, ROUTES[route]))
    expected = set(range(200, 211)) | {350, 550} | set(range(600, 611)) | set(range(700, 711)) | {850}
    assert found == {"DEST_VELOCITY": expected}


def test_velocity_against_brute_force(spark):
    rng = random.Random(5)
    hours = [None, -3, 0, 1, 1021, 1022, 1023, 1024, 1025, 1026, 2047, 2048, 2051]
    rows = [
        (i, rng.choice(hours), "DEBIT", 1, "C1", 1, 0, rng.choice(["C1", "C2", "M1", None]), 0, 1)
        for i in range(280)
    ]

    def peers(row):
        near = [r for r in rows if r[7] == row[7]]
        if row[1] is None:
            return sum(r[1] is None for r in near)
        return sum(r[1] is not None and row[1] - 3 <= r[1] <= row[1] for r in near)

    rule = [r for r in RULES if r.rule_code == "DEST_VELOCITY"]
    found = by_code(failing(make_warehouse(spark, rows), rule, AS_OF))
    expected = {row[0] for row in rows if peers(row) > 10}
    assert found["DEST_VELOCITY"] == expected and len(expected) < len(rows)


@pytest.mark.parametrize("route", ROUTES)
def test_outlier_by_type(spark, route):
    rows = [(i, 1, "DEBIT", 10 + i % 3, "C1", 0, 0, "M1", 0, 0) for i in range(100)]
    rows += [(200 + i, 1, None, 10 + i % 3, "C1", 0, 0, "M1", 0, 0) for i in range(100)]
    rows += [(500, 1, "DEBIT", 5000, "C1", 0, 0, "M1", 0, 0)]
    rows += [(501, 1, None, 5000, "C1", 0, 0, "M1", 0, 0)]
    rows += [(502, 1, "PAYMENT", 99999, "C1", 0, 0, "M1", 0, 0)]  # alone in its type
    rule = [r for r in RULES if r.rule_code == "AMOUNT_ZSCORE_BY_TYPE"]
    found = by_code(failing(make_warehouse(spark, rows), rule, AS_OF, ROUTES[route]))
    assert found == {"AMOUNT_ZSCORE_BY_TYPE": {500, 501}}


def test_model_rule_needs_scores(spark):
    wh = make_warehouse(spark, TEN)
    with pytest.raises(ValueError):
        failing(wh, [r for r in set_active(RULES, "ANOMALY_IFOREST") if r.kind == "model"], AS_OF)


def test_fused_equals_separate_and_ignores_layout(spark, sf_dir):
    wh = tb.warehouse(spark, sf_dir)
    together = by_code(failing(wh, RULES, AS_OF))
    assert sum(map(len, together.values())) == 782
    for rule in RULES:
        if rule.active:
            alone = {r[0] for r in failing_rule(wh, RULES, rule.rule_code, AS_OF).collect()}
            assert alone == together.get(rule.rule_code, set()), rule.rule_code


@pytest.mark.parametrize("route", ["shuffled", "split"])
def test_join_routes_agree_on_test_data(spark, sf_dir, route):
    wh = tb.warehouse(spark, sf_dir)
    moved = type(wh)(
        wh.fact.repartition(7), wh.customer_master, wh.settlements.repartition(3), wh.dim_customer
    )
    assert by_code(failing(moved, RULES, AS_OF, ROUTES[route])) == by_code(failing(wh, RULES, AS_OF))


def test_user_rules(spark):
    rules = add_rule(RULES, "BIG", "Validity", "LOW", "Big", predicate="amount >= 1000")
    rules = add_rule(
        rules, "TWICE", "Uniqueness", "LOW", "Sender seen twice",
        query="SELECT a.txn_id FROM {fact} a JOIN {fact} b ON a.name_orig = b.name_orig"
        " WHERE a.txn_id <> b.txn_id",
    )
    found = by_code(failing(make_warehouse(spark, TEN), rules[-2:], AS_OF), rules)
    assert found == {"BIG": {1, 4}, "TWICE": {1, 4}}
    with pytest.raises(ValueError):
        add_rule(rules, "BIG", "Validity", "LOW", "again", predicate="true")
    with pytest.raises(ValueError):
        add_rule(rules, "BAD", "Validity", "SEVERE", "unknown severity", predicate="true")


def test_catalog_shape():
    assert len(RULES) == 30 and sum(r.active for r in RULES) == 29
    severities = [r.severity for r in RULES]
    assert [severities.count(s) for s in ("HIGH", "MEDIUM", "LOW")] == [15, 14, 1]
