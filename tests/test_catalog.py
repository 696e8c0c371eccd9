from dataclasses import replace
from datetime import datetime

import pytest
from builders import AS_OF, make_warehouse
from test_rules import TEN

from ledgerwatch.functions.lookups import Limits
from ledgerwatch.operators.catalog import Rule, add_rule, catalog_frame, rules_from_frame, standard_rules
from ledgerwatch.operators.rules import failing, with_moment
from ledgerwatch.plans import testbed as tb

RULES = standard_rules()


def pairs(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_catalog_comes_back(spark):
    assert rules_from_frame(catalog_frame(spark, RULES)) == RULES
    plain = catalog_frame(spark, RULES).drop("kind", "params")
    back = rules_from_frame(plain)
    assert [(r.rule_code, r.kind) for r in back] == [(r.rule_code, r.kind) for r in RULES]
    assert back[27].limit("deviations") == 4
    with pytest.raises(ValueError):
        rules_from_frame(catalog_frame(spark, [*RULES, RULES[0]]))
    with pytest.raises(ValueError):
        Rule(1, "NEG_AMOUNT", "Validity", "HIGH", "x", "row", "amount < 0", params={"days": 1})


def test_limits_of_built_in_rules(spark, sf_dir):
    wh = tb.warehouse(spark, sf_dir)

    def count(code, **params):
        rules = [replace(r, params=params) for r in RULES if r.rule_code == code]
        return failing(wh, rules, AS_OF).count()

    assert count("DEST_VELOCITY", arrivals=0) == wh.fact.where("name_dest IS NOT NULL OR step IS NOT NULL").count()
    assert count("AMOUNT_ZSCORE_BY_TYPE", deviations=1) > count("AMOUNT_ZSCORE_BY_TYPE", deviations=4)
    assert count("LATE_SETTLEMENT", days=0) > count("LATE_SETTLEMENT", days=2) > count("LATE_SETTLEMENT", days=6)


def test_both_routes_agree_if_ids_repeat(spark, sf_dir):
    wh = tb.warehouse(spark, sf_dir)
    wh = replace(wh, fact=wh.fact.unionByName(wh.fact.where("txn_id % 10 = 0")))
    fused = pairs(failing(wh, RULES, AS_OF))
    assert fused == pairs(failing(wh, RULES, AS_OF, Limits(rows=0)))
    assert len(set(fused)) == len(fused)


def test_many_rules_equal_each_alone(spark):
    wh = make_warehouse(spark, TEN)
    rules = RULES
    for k in range(45):
        rules = add_rule(rules, f"U{k}", "Validity", "LOW", "x", predicate=f"amount >= {k}")
    own = rules[len(RULES):]
    together = pairs(failing(wh, own, AS_OF))
    alone = sorted((p for r in own for p in pairs(failing(wh, [r], AS_OF))), key=str)
    assert together == alone


def test_the_moment_is_not_replaced_in_quotes(spark):
    assert with_moment("a > :as_of AND b = ':as_of' AND c = 'it''s :as_of' AND `:as_of` = :as_ofx", "NOW") == (
        "a > NOW AND b = ':as_of' AND c = 'it''s :as_of' AND `:as_of` = :as_ofx"
    )
    rules = add_rule(RULES, "T", "Validity", "LOW", "x", predicate="txn_ts < :as_of AND ':as_of' LIKE '%as%'")
    wh = make_warehouse(spark, TEN)
    assert failing(wh, rules[-1:], datetime(2027, 1, 1)).count() == wh.fact.where("step IS NOT NULL").count()


def test_queries_name_all_tables(spark, sf_dir):
    wh = replace(tb.warehouse(spark, sf_dir), injected_defects=tb.damaged(spark, sf_dir)[1])
    text = "SELECT d.txn_id FROM {injected_defects} d WHERE d.defect_type = 'NEG_AMOUNT'"
    rules = add_rule(RULES, "SEEDED", "Validity", "LOW", "x", query=text)
    assert failing(wh, rules[-1:], AS_OF).count() > 0
