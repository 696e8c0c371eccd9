"""Joining a large table back to findings about its keys, without a hot task.

Findings come from a grouped aggregate, so they are unique on their keys and know
(`n`) how many rows of the large table carry each key. They are written out and
measured. Small ones are broadcast. Larger ones are split: the heaviest keys, a
fixed number at most, are broadcast, and all other keys go through a shuffle join
in which no key can hold more than a `1/hot_keys` share of the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.session import settle


@dataclass(frozen=True)
class Limits:
    """Bounds on what may be broadcast."""

    rows: int = 500_000
    bytes: int = 64 * 1024 * 1024
    hot_keys: int = 10_000
    hot_rows: int = 100_000


@dataclass(frozen=True)
class Lookup:
    """Findings, unique on `keys`, with the row count `n` of each key."""

    frame: DataFrame
    keys: tuple[str, ...]
    fits: bool
    limits: Limits


def _width(keys: tuple[str, ...]) -> Column:
    """Bytes of a key as text."""
    return sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in keys), F.lit(0))


def make_lookup(findings: DataFrame, keys: tuple[str, ...], limits: Limits = Limits()) -> Lookup:
    frame, seen = settle(findings, F.sum(_width(keys)).alias("key_bytes"))
    # 64 bytes a row is a generous allowance for the fixed-width columns
    size = (seen["key_bytes"] or 0) + 64 * seen["rows"]
    return Lookup(frame, keys, seen["rows"] <= limits.rows and size <= limits.bytes, limits)


def _renamed(frame: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The keys under names of their own, so that both sides of a join stay apart."""
    return frame.select(*[F.col(c).alias(f"_key_{c}" if c in keys else c) for c in frame.columns])


def _same_key(keys: tuple[str, ...], on: tuple[str, ...] | None = None):
    pairs = [F.col(ours).eqNullSafe(F.col(f"_key_{key}")) for ours, key in zip(on or keys, keys)]
    condition = pairs[0]
    for pair in pairs[1:]:
        condition = condition & pair
    return condition


def attach(rows: DataFrame, lookup: Lookup, how: str = "left", on: tuple[str, ...] | None = None):
    """Map-side join with a lookup that fits; `on` names the row columns if they differ."""
    if not lookup.fits:
        raise ValueError("lookup is above the broadcast bound, use join_back")
    keys = lookup.keys
    side = F.broadcast(_renamed(lookup.frame.drop("n"), keys))
    return rows.join(side, _same_key(keys, on), how).drop(*[f"_key_{key}" for key in keys])


def heaviest(counts: DataFrame, keys: tuple[str, ...], limits: Limits) -> DataFrame:
    """The keys with most rows: at most `hot_keys` of them, ties in a fixed order.

    Keys too long to be among them within `bytes` are left to the shuffle join.
    """
    short = _width(keys) + 64 <= max(1, limits.bytes // limits.hot_keys)
    ranked = counts.where((F.col("n") >= limits.hot_rows) & short).orderBy(F.desc("n"), *keys)
    return ranked.limit(limits.hot_keys).select(*keys)


def join_back(rows: DataFrame, lookup: Lookup, heavy: DataFrame | None = None) -> DataFrame:
    """Rows whose (null-safe) key is in the lookup, with the lookup's columns.

    `heavy` names the heaviest keys of the rows. It is needed if a key without findings
    can be heavy too; by default the heaviest keys of the lookup are taken.
    """
    if lookup.fits:
        return attach(rows, lookup, "inner")
    keys = lookup.keys
    if heavy is None:
        heavy = heaviest(lookup.frame, keys, lookup.limits)
    hot = F.broadcast(_renamed(heavy, keys))
    found_hot = lookup.frame.join(hot, _same_key(keys), "left_semi")
    heavy_rows = attach(rows, Lookup(found_hot, keys, True, lookup.limits), "inner")
    cold_rows = rows.join(hot, _same_key(keys), "left_anti")
    cold = _renamed(lookup.frame.join(hot, _same_key(keys), "left_anti").drop("n"), keys)
    light_rows = cold_rows.join(cold, _same_key(keys), "inner").drop(*[f"_key_{key}" for key in keys])
    return heavy_rows.unionByName(light_rows)
