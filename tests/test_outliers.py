from decimal import Decimal
from fractions import Fraction

import pytest
from builders import AS_OF, make_warehouse, staged_frame
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerwatch.operators.catalog import standard_rules
from ledgerwatch.operators.rules import (
    MOMENTS,
    amount_moments,
    failing_rule,
    highest_ordinary,
    outlier_ceilings,
)

OUTLIER = "AMOUNT_ZSCORE_BY_TYPE"


def over(amounts, x, deviations):
    """Whether x is over the mean by more than so many sample deviations, in exact fractions."""
    n = len(amounts)
    mean = Fraction(sum(amounts), n)
    variance = sum((a - mean) ** 2 for a in amounts) / (n - 1)
    return x > mean and (x - mean) ** 2 > deviations**2 * variance


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.integers(-(10**17), 10**17) | st.integers(-50, 50), min_size=2, max_size=30),
    st.sampled_from(["0", "0.1", "1", "2.5", "4"]),
)
def test_highest_ordinary_is_the_exact_edge(amounts, deviations):
    times = Fraction(deviations)
    top = highest_ordinary(len(amounts), sum(amounts), sum(a * a for a in amounts), times)
    assert not over(amounts, top, times) and over(amounts, top + 1, times)


def row(number, kind, amount):
    return (number, 1, kind, amount, "C1", "0", "0", "C2", "0", "0")


def test_an_amount_exactly_on_the_cut_is_ordinary(spark):
    # fifteen zeros and x: mean x/16, deviation x/4, so x is 3.75 deviations over the mean
    rows = [row(k, "DEBIT", "0.00") for k in range(15)] + [row(99, "DEBIT", "0.07")]
    rows += [row(100 + k, "PAYMENT", "0.00") for k in range(15)] + [row(199, "PAYMENT", "123456789012345.67")]
    fact = staged_frame(spark, rows)
    on = {r.type: r.ceiling for r in outlier_ceilings(amount_moments(fact), 3.75).collect()}
    assert on == {"DEBIT": Decimal("0.07"), "PAYMENT": Decimal("123456789012345.67")}
    below = {r.type: r.ceiling for r in outlier_ceilings(amount_moments(fact), 3.74).collect()}
    assert below["DEBIT"] == Decimal("0.06") and below["PAYMENT"] < on["PAYMENT"]


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_any_partitioning_gives_the_same(spark, parts):
    rows = [row(k, ("DEBIT", "PAYMENT", None)[k % 3], f"{(k * 7919) % 100_000_000_000_000}.{k % 100:02d}") for k in range(300)]
    rows += [row(1000, "CASH_IN", "5.00"), row(1001, None, None), row(1002, "DEBIT", "9999999999999999.99")]
    fact = staged_frame(spark, rows)
    sums = {tuple(r) for r in amount_moments(fact.repartition(parts)).select("type", *MOMENTS).collect()}
    assert sums == {tuple(r) for r in amount_moments(fact.coalesce(1)).select("type", *MOMENTS).collect()}
    got = {r.type: r.ceiling for r in outlier_ceilings(amount_moments(fact.repartition(parts)), 4).collect()}
    assert "CASH_IN" not in got  # one amount has no deviation
    for kind, ceiling in got.items():
        cents = [int(Decimal(r[3]) * 100) for r in rows if r[2] == kind and r[3] is not None]
        assert not over(cents, int(ceiling * 100), 4) and over(cents, int(ceiling * 100) + 1, 4)


def test_rule_over_tables(spark):
    rows = [row(k, "DEBIT", "10.00") for k in range(40)] + [row(99, "DEBIT", "9000000000000000.00")]
    wh = make_warehouse(spark, rows)
    assert [r.txn_id for r in failing_rule(wh, standard_rules(), OUTLIER, AS_OF).collect()] == [99]
