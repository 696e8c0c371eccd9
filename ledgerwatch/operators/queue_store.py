"""The exception queue as a stored table that grows, is updated, and is never read to insert into it.

Items lie in bands of transaction ids, each split by status. Beside them every band has bitmaps of
the (rule, transaction) pairs it holds. A run tests its findings against the bitmaps of the bands it
touches; the queue itself is not opened. An update batch rewrites the bands it touches, so `OPEN`
items are the files of one status.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.operators.queue import OPEN, apply_updates, new_exceptions
from ledgerwatch.session import settle
from ledgerwatch.sources.parts import Parts, values
from ledgerwatch.sources.schemas import EXCEPTIONS

BAND = 1 << 26  # transaction ids in a band
NO_BAND = -(1 << 40)  # of items without an id

_ITEMS = ", ".join([*[c for c in EXCEPTIONS.split(", ") if not c.startswith("status ")], "band bigint", "status string"])
_BITS = "rule_id int, bucket bigint, bits binary, band bigint"


def band_of(txn_id: str, width: int = BAND) -> Column:
    return F.coalesce(F.floor(F.col(txn_id) / width), F.lit(NO_BAND))


@dataclass(frozen=True)
class QueueStore:
    """The stored queue: `items` by band and status, `bits` by band."""

    items: Parts
    bits: Parts
    width: int = BAND

    @classmethod
    def at(cls, spark: SparkSession, folder: str, width: int = BAND) -> QueueStore:
        """The store in a folder, made empty if it is not there."""
        items = Parts(spark, os.path.join(folder, "items"), _ITEMS, ("band", "status"))
        bits = Parts(spark, os.path.join(folder, "bits"), _BITS, ("band",))
        return cls(items.create(), bits.create(), width)

    def read(self, status: str | None = None) -> DataFrame:
        """The items, in the columns of a queue; those of one status are files of their own."""
        rows = self.items.read().where("exception_id IS NOT NULL")
        rows = rows if status is None else rows.where(F.col("status") == status)
        return rows.select(*[c.split()[0] for c in EXCEPTIONS.split(", ")])

    def open_items(self) -> DataFrame:
        return self.read(OPEN)

    def mark(self, findings: DataFrame) -> DataFrame:
        """(rule_id, txn_id, is_new): the findings, each once, and whether they are not queued yet.

        Only the bitmaps of the bands that the findings lie in are read.
        """
        pairs = findings.select(F.col("rule_id").cast("int").alias("rule_id"), "txn_id").distinct()
        placed, _ = settle(
            pairs.select("rule_id", "txn_id", band_of("txn_id", self.width).alias("band"),
                         F.expr("bitmap_bucket_number(txn_id)").alias("bucket"), F.expr("bitmap_bit_position(txn_id)").alias("bit"))
        )
        known = self.bits.read(values(placed, "band"))
        # bitmaps of one bucket from several runs become one; a null bucket stands for the null id
        known = known.groupBy("rule_id", "bucket").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
        same = (F.col("f.rule_id") == F.col("k.rule_id")) & F.col("f.bucket").eqNullSafe(F.col("k.bucket"))
        byte = "CAST(conv(hex(substring(k.bits, CAST(f.bit div 8 AS INT) + 1, 1)), 16, 10) AS INT)"
        queued = F.expr(f"k.rule_id IS NOT NULL AND (f.bucket IS NULL OR getbit({byte}, CAST(f.bit % 8 AS INT)) = 1)")
        return placed.alias("f").join(known.alias("k"), same, "left").select(
            "f.rule_id", "f.txn_id", (~queued).alias("is_new")
        )

    def insert(self, findings: DataFrame, run_ts: datetime) -> DataFrame:
        """Queue the findings that are not queued yet, and return all of them marked (written)."""
        marked, seen = settle(self.mark(findings), F.count_if("is_new").alias("new"))
        if seen["new"]:
            band = band_of("txn_id", self.width).alias("band")
            fresh = marked.where("is_new").select("rule_id", "txn_id", band)
            bucket = F.expr("bitmap_bucket_number(txn_id)").alias("bucket")
            bits = F.expr("bitmap_construct_agg(coalesce(bitmap_bit_position(txn_id), 0))").alias("bits")
            # items first: bitmaps without items would hide findings for good
            self.items.append(new_exceptions(marked, run_ts).select("*", band))
            self.bits.append(fresh.groupBy("rule_id", "band", bucket).agg(bits))
        return marked

    def update(self, updates: DataFrame) -> None:
        """Apply analyst updates, as `apply_updates` does, to the bands that they touch and to no other.

        A status that a band no longer has is replaced by a row without an item, so that one write
        both adds and takes away.
        """
        band = band_of("txn_id", self.width).alias("band")
        updates, _ = settle(updates.select("*", band))
        touched = values(updates, "band")
        before = self.items.read(touched).where("exception_id IS NOT NULL")
        after, _ = settle(apply_updates(before, updates.drop("band")))
        emptied = self.items.read(touched).select("band", "status").distinct().join(
            after.select("band", "status").distinct(), ["band", "status"], "left_anti"
        )
        blanks = [F.lit(None).cast(after.schema[c].dataType).alias(c) for c in after.columns if c not in ("band", "status")]
        rows, _ = settle(after.unionByName(emptied.select("band", "status", *blanks)))
        self.items.replace(rows)
