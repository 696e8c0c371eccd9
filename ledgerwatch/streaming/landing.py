"""The rules on one row, run on transaction files as they land, into the same queue.

Nothing here is a rule of its own: it is the batch run of the row rules, driven by new
files instead of a clock. Rules that compare rows need the whole table and stay in the
batch run.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerwatch.operators.catalog import ROW, Rule
from ledgerwatch.operators.queue import mark_new, new_exceptions
from ledgerwatch.operators.rules import row_hits
from ledgerwatch.operators.staging import stage
from ledgerwatch.operators.warehouse import fact_transactions
from ledgerwatch.sources.schemas import EXCEPTIONS, FEED_OPTIONS, landing_schema
from ledgerwatch.sources.tables import append_table, read_table


def landed_transactions(spark: SparkSession, path: str) -> DataFrame:
    """A stream of fact rows from keyed transaction feeds dropped into a folder."""
    raw = (
        spark.readStream.schema(landing_schema("transactions", keyed=True))
        .options(**FEED_OPTIONS)
        .csv(path)
    )
    return fact_transactions(stage(raw, "transactions"))


def queue_landed(
    landed: DataFrame, rules: Iterable[Rule], as_of: datetime, queue_path: str, checkpoint: str
) -> StreamingQuery:
    """Check what has landed and append what is new to the queue.

    A batch that is run again after a failure finds its rows queued and adds nothing.
    """
    spark = landed.sparkSession
    active = [rule for rule in rules if rule.active and rule.kind == ROW]
    append_table(spark.createDataFrame([], EXCEPTIONS), queue_path)

    def add(batch: DataFrame, _number: int) -> None:
        # only queue rows on the batch's transactions can be repeats: their range of ids prunes
        # the queue's files, which hold the ids of one batch each
        batch.persist()
        low, high, nulls = batch.agg(F.min("txn_id"), F.max("txn_id"), F.count_if(F.col("txn_id").isNull())).first()
        near = F.col("txn_id").between(low, high) if low is not None else F.lit(False)
        if nulls:
            near = near | F.col("txn_id").isNull()
        queued = read_table(spark, queue_path, EXCEPTIONS).where(near)
        fresh = new_exceptions(mark_new(batch, queued), as_of)
        append_table(fresh.repartitionByRange("txn_id").sortWithinPartitions("txn_id"), queue_path)
        batch.unpersist()

    return (
        row_hits(landed, active, as_of)
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
