"""Seeded defects: damage a known set of staged rows and log which, as ground truth."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.draws import MODULUS, bent, bucket, draw
from ledgerwatch.functions.expressions import MONEY

# Defect types and their rates.
RATES = {
    "NULL_AMOUNT": 0.002,
    "NEG_AMOUNT": 0.002,
    "DUP_TXN": 0.002,
    "BAD_ACCT_FORMAT": 0.001,
    "INVALID_TYPE": 0.001,
    "BAL_TAMPERING": 0.002,
    "STEP_OUT_OF_RANGE": 0.001,
    "ZERO_AMOUNT": 0.001,
}

# The draws of the test data (one bucket in a thousand is a rate of 0.001).
TEST_DRAWS = {
    "NULL_AMOUNT": (0, 1),
    "NEG_AMOUNT": (2, 3),
    "DUP_TXN": (4, 5),
    "BAD_ACCT_FORMAT": (6,),
    "INVALID_TYPE": (8,),
    "BAL_TAMPERING": (9, 10),
    "STEP_OUT_OF_RANGE": (11,),
    "ZERO_AMOUNT": (12,),
}


Draws = Mapping[str, str]


def draws_for(rates: Mapping[str, float]) -> dict[str, str]:
    """Disjoint ranges of the draw for the given rates, so no row gets two defects.

    A range is as fine as the draw itself: rates down to one in two thousand million count.
    """
    conditions, start = {}, 0.0
    for defect, rate in rates.items():
        stop = start + rate * MODULUS
        conditions[defect] = f"_draw >= {math.ceil(start)}L AND _draw < {math.ceil(stop)}L"
        start = stop
    if start > MODULUS * (1 + 1e-9):
        raise ValueError("rates add up to more than 1")
    return conditions


def bucket_draws(buckets: Mapping[str, tuple[int, ...]]) -> dict[str, str]:
    """Given buckets in a thousand for each defect."""
    return {d: f"_bucket IN ({', '.join(map(str, own))})" for d, own in buckets.items()}


def _hits(conditions: Draws) -> dict[str, str]:
    """The condition under which a row gets each defect. Sign and zero need an amount over 0."""
    guarded = ("NEG_AMOUNT", "ZERO_AMOUNT")
    return {
        defect: f"({conditions[defect]}{' AND amount > 0' if defect in guarded else ''})"
        if defect in conditions
        else "false"
        for defect in RATES
    }


def _offset(staged: DataFrame, duplicate_offset: int | None) -> int:
    if duplicate_offset is None:
        return staged.agg(F.max("txn_id")).first()[0] or 0
    return duplicate_offset


def inject_defects(
    staged: DataFrame,
    conditions: Draws | None = None,
    seed: int = 0,
    duplicate_offset: int | None = None,
    exclusive: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The damaged table and the log (txn_id, defect_type).

    One pass each, no join: the draw is a function of txn_id and seed, and a duplicate is an
    extra element of an exploded id array. A copy's id is the original's plus
    `duplicate_offset` (by default the highest id there is). With `exclusive` a row gets one
    defect at most. Without, rows are copied by a draw of their own, and originals and copies
    are then damaged each by its own id, so a copy may differ from its original.
    """
    offset = _offset(staged, duplicate_offset)
    hit = _hits(draws_for(RATES) if conditions is None else conditions)
    copied, copy = hit.pop("DUP_TXN"), f"txn_id + {offset}L"
    drawn = staged.withColumn("_draw", draw("txn_id", seed if exclusive else seed + 1))
    drawn = drawn.withColumn("_bucket", bucket("txn_id"))
    others = [c for c in staged.columns if c != "txn_id"]
    both = f"explode(IF({copied}, array(txn_id, {copy}), array(txn_id))) AS txn_id"
    original = f"IF({copied}, txn_id, NULL) AS _original"
    rows = drawn.selectExpr("_draw", "_bucket", original, both, *others)
    if not exclusive:
        rows = rows.withColumn("_draw", bent(draw("txn_id", seed))).withColumn("_bucket", bucket("txn_id"))
    damage = {
        "step": f"IF({hit['STEP_OUT_OF_RANGE']}, -1, step)",
        "type": f"IF({hit['INVALID_TYPE']}, 'WIRE', type)",
        "amount": f"CASE WHEN {hit['NULL_AMOUNT']} THEN NULL"
        f" WHEN {hit['NEG_AMOUNT']} THEN CAST(-amount AS {MONEY})"
        f" WHEN {hit['ZERO_AMOUNT']} THEN CAST(0 AS {MONEY}) ELSE amount END",
        "name_orig": f"IF({hit['BAD_ACCT_FORMAT']}, concat('INVALID_', txn_id), name_orig)",
        "newbalance_orig": f"IF({hit['BAL_TAMPERING']},"
        f" CAST(newbalance_orig * 1.5 AS {MONEY}), newbalance_orig)",
    }
    damaged = rows.selectExpr("txn_id", *[f"{damage.get(c, c)} AS {c}" for c in others])
    label = " ".join(f"WHEN {condition} THEN '{defect}'" for defect, condition in hit.items())
    defects = (
        "filter(array(IF(_original <> txn_id, 'DUP_TXN', NULL),"
        f" CASE {label} END), d -> d IS NOT NULL)"
    )
    log = rows.selectExpr("txn_id", f"explode({defects}) AS defect_type")
    return damaged, log


def defect_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("defect_type").agg(F.count(F.lit(1)).alias("injected"))
