import random
from dataclasses import replace

import pytest
from builders import AS_OF, make_warehouse

from ledgerwatch.functions.lookups import Limits
from ledgerwatch.operators.catalog import (
    JOINED,
    SETTLEMENT,
    add_rule,
    catalog_frame,
    rules_from_frame,
    standard_rules,
)
from ledgerwatch.operators.rules import failing, renamed_table, settlement_hits
from ledgerwatch.plans import testbed as tb
from ledgerwatch.session import settle
from ledgerwatch.sources import tables

RULES = standard_rules()


def pairs(frame):
    return {tuple(r) for r in frame.collect()}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def wh(spark):
    return tb.warehouse(spark, "/root/testdata/sf0.001")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_tables_join_without_a_shuffle(spark, wh, tmp_path, no_broadcast):
    stored = {}
    for name in ("fact", "settlements"):
        rows, path = getattr(wh, name), str(tmp_path / name)
        tables.write_bucketed(rows, path, "txn_id", 4)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
        stored[name] = tables.read_bucketed(spark, path, columns, "txn_id", 4)
        assert stored[name].exceptAll(rows).isEmpty() and rows.exceptAll(stored[name]).isEmpty()
    rules = {rule.rule_code: rule for rule in RULES if rule.kind == SETTLEMENT}
    plain, bucketed = settlement_hits(wh, rules), settlement_hits(replace(wh, **stored), rules)
    assert "Exchange" in plan_of(plain) and "Exchange" not in plan_of(bucketed)
    assert pairs(bucketed) == pairs(plain) and len(pairs(plain)) > 0


def joined_and_queries():
    """The same rules as joined ones and as queries."""
    joined, queries = RULES, RULES
    cases = [
        ("dim_customer", "name_orig", "dim_customer.kyc_status = 'REJECTED' AND type = 'TRANSFER'"),
        ("dim_customer", "name_dest", "dim_customer.country <> 'dim_customer.x' AND amount > 200000"),
        ("dim_customer", "name_dest", "dim_customer.segment IS NULL"),
        ("dim_time", "step", "dim_time.hour_of_day = 3"),
        ("dim_txn_type", "type", "dim_txn_type.direction = 'CREDIT' AND txn_ts < :as_of"),
    ]
    keys = {"dim_customer": "account_id", "dim_time": "time_key", "dim_txn_type": "type"}
    for k, (table, column, text) in enumerate(cases):
        joined = add_rule(joined, f"J{k}", "Validity", "LOW", "joined", predicate=text, joined=(table, column))
        on = f"fact.{column} = {table}.{keys[table]}"
        text = text.replace("type = 'TRANSFER'", "fact.type = 'TRANSFER'").replace("txn_ts < :as_of", "fact.txn_ts < TIMESTAMP_NTZ '2026-01-20 00:00:00'")
        queries = add_rule(queries, f"J{k}", "Validity", "LOW", "query", query=f"SELECT fact.txn_id FROM {{fact}} fact JOIN {{{table}}} {table} ON {on} WHERE {text}")
    return joined[len(RULES):], queries[len(RULES):]


@pytest.mark.parametrize("limits", [Limits(), Limits(rows=0, hot_keys=2, hot_rows=5)])
def test_joined_rules_are_what_queries_find(wh, limits):
    joined, queries = joined_and_queries()
    want = pairs(failing(wh, queries, AS_OF))
    assert pairs(failing(wh, joined, AS_OF, limits)) == want and len(want) > 50
    assert {rule for rule, _ in want} == {31, 32, 34, 35}


def test_twenty_joined_rules_scan_the_fact_once(spark, wh, tmp_path):
    from ledgerwatch.plans.queries import _joined_rules

    fact, _ = settle(wh.fact)
    stored = replace(wh, fact=fact, dim_customer=settle(wh.dim_customer)[0])
    rules = _joined_rules()
    assert len(rules) == 20
    plan = plan_of(failing(stored, rules, AS_OF))
    assert plan.count("name_dest#") and sum("FileScan" in line and "name_dest" in line for line in plan.splitlines()) == 1


def test_no_row_of_the_dimension_and_null_keys(spark):
    rows = [
        (1, 1, None, "1.00", None, "1.00", "0.00", "C2", "0.00", "1.00"),
        (2, 1, "DEBIT", "1.00", "C1", "1.00", "0.00", "C9", "0.00", "1.00"),
    ]
    wh = make_warehouse(spark, rows, [(None, "A", None, "X", None), ("C1", "A", None, "X", None)])
    rules = add_rule(RULES, "UNKNOWN", "Validity", "LOW", "no status", predicate="dim_customer.kyc_status IS NULL", joined=("dim_customer", "name_orig"))
    assert pairs(failing(wh, rules[-1:], AS_OF)) == {(31, 2)}


def test_joined_rules_in_a_stored_catalog(spark):
    rules = add_rule(RULES, "REJECTED", "Validity", "LOW", "x", predicate="dim_customer.kyc_status = 'REJECTED'", joined=("dim_customer", "name_orig"))
    assert rules_from_frame(catalog_frame(spark, rules))[-1] == rules[-1] and rules[-1].kind == JOINED
    assert rules_from_frame(catalog_frame(spark, rules).drop("kind", "params"))[-1].kind == JOINED
    for bad in (("customer_master", "name_orig"), ("dim_customer", "name orig")):
        with pytest.raises(ValueError, match="joined rule reads"):
            add_rule(RULES, "BAD", "Validity", "LOW", "x", predicate="true", joined=bad)
    with pytest.raises(ValueError, match="needs a predicate"):
        add_rule(RULES, "BAD", "Validity", "LOW", "x", query="SELECT 1 AS txn_id", joined=("dim_customer", "name_orig"))


def test_renaming_leaves_quotes_alone():
    text = "dim_time.hour = 1 AND x <> 'dim_time.a' AND `dim_time.b` AND my_dim_time.c AND dim_time .d"
    assert renamed_table(text, "dim_time", "_t") == "_t.hour = 1 AND x <> 'dim_time.a' AND `dim_time.b` AND my_dim_time.c AND _t.d"


def test_interleaved_layout_leaves_row_groups_out(spark, tmp_path):
    rng = random.Random(3)
    n = 60_000
    fact = spark.createDataFrame(
        [(k, rng.randrange(744), f"C{rng.randrange(3000)}", f"C{rng.randrange(3000)}" if k % 3 else "C7") for k in range(n)],
        "txn_id bigint, step int, name_orig string, name_dest string",
    )
    path = str(tmp_path / "fact")
    tables.write_interleaved_layout(fact, path, files=8, row_group=16 << 10, distinct=1000)
    laid = spark.read.parquet(path)
    assert laid.exceptAll(fact).isEmpty() and laid.count() == n
    lookups = {
        "dest": lambda f: tables.party_rows(f, "name_dest", "C11"),
        "dest, hours": lambda f: tables.party_rows(f, "name_dest", "C7", 100, 120),
        "orig": lambda f: tables.party_rows(f, "name_orig", "C12"),
        "txn": lambda f: f.where("txn_id = 4242"),
    }
    for name, lookup in lookups.items():
        assert pairs(lookup(laid)) == pairs(lookup(fact)), name
        assert tables.rows_scanned(lookup(laid)) < n / 4, name
    # a busy destination is dealt over several files
    busy = laid.where("name_dest = 'C7'").selectExpr("input_file_name() AS f").groupBy("f").count()
    assert busy.count() > 2
