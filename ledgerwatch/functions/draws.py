"""Repeatable row draws: a pure function of the row id and a seed, so any engine and layout agrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The modulus 2^31 - 1, two multipliers of the minimal standard generator, and a large
# one that spreads consecutive ids over the whole range.
MODULUS = 2147483647
MULTIPLIER = 48271
SEED_STEP = 16807
SPREADER = 1583458089
BUCKETS = 1000


def draw(row_id: str = "txn_id", seed: int = 0) -> Column:
    """A number from 0 to MODULUS - 1. The id is reduced first, so large ids cannot overflow.

    A seed moves the ids by a multiple of its own before they are spread, so every seed draws
    each share of the rows alike.
    """
    shift = seed * SEED_STEP % MODULUS
    residue = F.pmod(F.col(row_id), F.lit(MODULUS).cast("bigint")) + F.lit(shift).cast("bigint")
    return F.pmod(residue * F.lit(SPREADER).cast("bigint"), F.lit(MODULUS).cast("bigint"))


def bent(drawn: Column) -> Column:
    """A draw squared: ids a fixed distance apart, like copies and originals, no longer go together."""
    return F.pmod(drawn * drawn, F.lit(MODULUS).cast("bigint"))


def bucket(row_id: str = "txn_id") -> Column:
    """Bucket 0..999 of a row, under the one draw of the test data."""
    residue = F.pmod(F.col(row_id), F.lit(MODULUS).cast("bigint"))
    return (F.pmod(residue * F.lit(MULTIPLIER).cast("bigint"), F.lit(MODULUS)) % BUCKETS).cast("int")
