"""The exception queue: insert what is new, log every run, move items through their states."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.operators.catalog import Rule, catalog_frame

# The states of an exception, in order.
OPEN, ASSIGNED, RESOLVED = "OPEN", "ASSIGNED", "RESOLVED"


def utc(moment: datetime) -> datetime:
    """A time without a zone is UTC already; one with a zone is converted."""
    return moment if moment.tzinfo is None else moment.astimezone(UTC).replace(tzinfo=None)


def instant(moment: datetime) -> Column:
    """A run time as a UTC instant, whatever the session's time zone."""
    return F.to_timestamp(F.lit(f"{utc(moment):%Y-%m-%d %H:%M:%S.%f}+00:00"))


def mark_new(hits: DataFrame, queue: DataFrame | None) -> DataFrame:
    """The pairs of this run, each once, with `is_new` false for those already queued.

    One aggregate over both sides does the distinct and the anti join together, folds
    before it shuffles, and treats NULL ids as one value.
    """
    pairs = hits.select("rule_id", "txn_id", F.lit(True).alias("hit"))
    if queue is None:
        return pairs.groupBy("rule_id", "txn_id").agg(F.max("hit").alias("is_new"))
    queued = queue.select("rule_id", "txn_id", F.lit(False).alias("hit"))
    return (
        pairs.unionByName(queued)
        .groupBy("rule_id", "txn_id")
        .agg(F.max("hit").alias("hit"), F.min("hit").alias("is_new"))
        .where("hit")
        .select("rule_id", "txn_id", "is_new")
    )


def new_exceptions(marked: DataFrame, run_ts: datetime) -> DataFrame:
    """Queue rows for the new pairs, with the opening state."""
    return marked.where("is_new").select(
        F.xxhash64("rule_id", "txn_id").alias("exception_id"),
        F.col("rule_id").cast("int").alias("rule_id"),
        "txn_id",
        instant(run_ts).alias("detected_at"),
        F.lit(OPEN).alias("status"),
        F.lit(None).cast("string").alias("assigned_to"),
        F.lit(None).cast("timestamp").alias("resolved_at"),
        F.lit(None).cast("string").alias("note"),
    )


def run_log(
    marked: DataFrame, fact: DataFrame, rules: Iterable[Rule], run_ts: datetime
) -> DataFrame:
    """One row per active rule, also for rules nothing broke.

    `records_failed` counts newly queued rows; `records_failing` counts all that fail now.
    """
    rules = [rule for rule in rules if rule.active]
    active = catalog_frame(fact.sparkSession, rules).select("rule_id")
    counts = marked.groupBy("rule_id").agg(
        F.count_if("is_new").alias("failed"), F.count(F.lit(1)).alias("failing")
    )
    checked = fact.agg(F.count(F.lit(1))).scalar()
    return active.join(counts, "rule_id", "left").select(
        F.xxhash64("rule_id", instant(run_ts)).alias("run_id"),
        "rule_id",
        instant(run_ts).alias("run_ts"),
        checked.alias("records_checked"),
        F.coalesce("failed", F.lit(0)).cast("bigint").alias("records_failed"),
        F.coalesce("failing", F.lit(0)).cast("bigint").alias("records_failing"),
    )


def _rank(state: Column) -> Column:
    """1 to 3 for the states in their order; 0 for anything else, which moves nothing."""
    return F.array_position(F.array(F.lit(OPEN), F.lit(ASSIGNED), F.lit(RESOLVED)), state)


def apply_updates(queue: DataFrame, updates: DataFrame) -> DataFrame:
    """The queue after analyst updates (rule_id, txn_id, status, assigned_to, note, updated_at).

    Updates to one item count in the order of their times, of equal ones the lower state first.
    An item only moves forward, OPEN to ASSIGNED to RESOLVED: an update to a state below the one
    reached changes nothing, all others are accepted. The item has the highest state reached, the
    last owner and the last note that an accepted update gave, and the time it was first resolved.
    So one batch gives what its updates would give one by one.

    An update is accepted if it is no later than the first one to a higher state. Two aggregates
    find those times and then the last values, so no item's updates meet in one list.
    """
    sent = updates.select(
        F.col("rule_id").cast("int").alias("_rule"),
        F.col("txn_id").alias("_txn"),
        _rank(F.col("status")).cast("int").alias("_rank"),
        F.col("assigned_to").alias("_owner"),
        F.col("note").alias("_note"),
        F.col("updated_at").alias("_at"),
    ).where("_rank > 0")
    same = F.col("rule_id").eqNullSafe(F.col("_rule")) & F.col("txn_id").eqNullSafe(F.col("_txn"))
    item = ["_rule", "_txn"]
    reached = sent.groupBy(*item).agg(
        F.min(F.when(F.col("_rank") > 1, F.col("_at"))).alias("_assigned"),
        F.min(F.when(F.col("_rank") > 2, F.col("_at"))).alias("_resolved"),
        F.max("_rank").alias("_top"),
    )
    state = queue.select("rule_id", "txn_id", _rank(F.col("status")).cast("int").alias("_state"))
    reached = reached.join(state.distinct(), same).drop("rule_id", "txn_id")
    keys = [c for c in reached.columns if c not in item]
    named = reached.select(*[F.col(c).alias(f"{c}_") if c in item else F.col(c) for c in reached.columns])
    higher = F.when(F.col("_rank") == 1, F.col("_assigned")).when(F.col("_rank") == 2, F.col("_resolved"))
    accepted = (F.col("_rank") >= F.col("_state")) & (higher.isNull() | (F.col("_at") <= higher))

    def last(value: str) -> Column:
        given = F.when(accepted & F.col(value).isNotNull(), F.struct("_at", "_rank", value))
        return F.max(given)[value].alias(value)

    met = sent.join(named, sent["_rule"].eqNullSafe(named["_rule_"]) & sent["_txn"].eqNullSafe(named["_txn_"]))
    moves = met.groupBy(*item, *keys).agg(last("_owner"), last("_note"))
    joined = queue.join(moves, same, "left")
    moved = F.col("_top") > F.col("_state")
    closes = (F.col("_top") == 3) & (F.col("_state") < 3)
    changed = {
        "status": F.when(moved, F.element_at(F.array(F.lit(OPEN), F.lit(ASSIGNED), F.lit(RESOLVED)), F.col("_top")))
        .otherwise(F.col("status")),
        "assigned_to": F.coalesce("_owner", "assigned_to"),
        "resolved_at": F.when(closes, F.col("_resolved")).otherwise(F.col("resolved_at")),
        "note": F.coalesce("_note", "note"),
    }
    return joined.select(*[changed.get(c, F.col(c)).alias(c) for c in queue.columns])
