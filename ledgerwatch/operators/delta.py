"""Rule runs on what has come in since the last one, equal to runs on all history.

For every rule that compares rows the store keeps what its findings are made of, as partial aggregates
that add up: first ids and counts of keys, hourly cells, power sums, folded settlements, accounts. They
lie in parts by time, band of ids or hash. A run appends its own aggregates and reads the parts that its
keys lie in. Old rows whose verdict changes are found from the old and the new aggregates, and looked up
in narrow tables by the same parts, so the fact is never read as a whole.

`txn_id` is the key of the fact. Rows only come in; they do not change and do not go.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.functions.lookups import Limits, join_back, make_lookup
from ledgerwatch.operators.catalog import (
    ACCOUNT,
    COPIES,
    OUTLIER,
    REFERENCE,
    ROW,
    SETTLEMENT,
    VELOCITY,
    Rule,
)
from ledgerwatch.operators.queue_store import BAND, band_of
from ledgerwatch.operators.rules import (
    BUSINESS_KEY,
    KEY_TESTS,
    MOMENTS,
    account_flags,
    accounts_in_use,
    amount_moments,
    busy_cells,
    outlier_ceilings,
    row_hits,
    with_moment,
)
from ledgerwatch.session import settle
from ledgerwatch.sources.parts import Parts, values

HOURS = 24  # in a part by time
HASHES = 16  # parts of tables by hash
NO_HOUR = -(1 << 40)  # the part of rows without an hour

_MONEY = "decimal(18,2)"
_KEY = f"name_orig string, name_dest string, amount {_MONEY}, step int, type string"
_MOMENTS = ", ".join(f"{c} {'bigint' if c in ('n', 'amounts') else 'decimal(38,0)'}" for c in MOMENTS)
_FACT = (
    f"txn_id bigint, step int, txn_ts timestamp_ntz, type string, amount {_MONEY}, name_orig string, "
    f"oldbalance_org {_MONEY}, newbalance_orig {_MONEY}, name_dest string, oldbalance_dest {_MONEY}, "
    f"newbalance_dest {_MONEY}, is_fraud smallint, is_flagged_fraud smallint"
)

# every table of the store, and what its parts are
TABLES = {
    "fact": f"{_FACT}, part bigint",  # by time
    "copies": f"{_KEY}, first_id bigint, n bigint, part bigint",  # by time
    "cells": "name_dest string, step int, n bigint, part bigint",  # by time
    "moments": f"type string, {_MOMENTS}, part bigint",  # one part
    "amounts": f"type string, amount {_MONEY}, txn_id bigint, part bigint",  # by size
    "settled": f"txn_id bigint, low {_MONEY}, high {_MONEY}, first_ts timestamp_ntz, rows bigint, "
    f"least {_MONEY}, most {_MONEY}, latest date, settlements bigint, part bigint",  # by band of ids
    "references": "settlement_ref string, first_id bigint, firsts bigint, n bigint, part bigint",  # by hash
    "accounts": "account string, copies bigint, part bigint",  # by hash
    "parties": "account string, origin boolean, txn_id bigint, part bigint",  # by hash
    "failing": "txn_id bigint, fails boolean, run bigint, rule_id int",  # by rule
}
KINDS = (ROW, COPIES, OUTLIER, VELOCITY, SETTLEMENT, REFERENCE, ACCOUNT)


def hash_part(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(HASHES))


def size_of(amount: Column) -> Column:
    """Binary digits of an amount in cents; amounts that are not over zero have none."""
    cents = (amount * 100).cast("bigint")
    return F.when(cents > 0, F.length(F.bin(cents))).otherwise(0)


def stacked(parts: Iterable[DataFrame]) -> DataFrame:
    result, *rest = parts
    for part in rest:
        result = result.unionByName(part)
    return result


def _first(id_: str, n: str) -> Column:
    """The lowest id with its count, NULL last."""
    return F.min(F.struct(F.col(id_).isNull().alias("none"), F.col(id_).alias("id"), F.col(n).alias("n")))


def folded_settlements(settlements: DataFrame) -> DataFrame:
    return settlements.where("txn_id IS NOT NULL").groupBy("txn_id").agg(
        F.min("settled_amount").alias("least"), F.max("settled_amount").alias("most"),
        F.max("settlement_date").alias("latest"), F.count(F.lit(1)).alias("settlements"),
    )


def folded_references(settlements: DataFrame) -> DataFrame:
    pairs = settlements.groupBy("settlement_ref", "txn_id").agg(F.count(F.lit(1)).alias("copies"))
    return pairs.groupBy("settlement_ref").agg(_first("txn_id", "copies").alias("first"), F.sum("copies").alias("n")).select(
        "settlement_ref", F.col("first.id").alias("first_id"), F.col("first.n").alias("firsts"), "n", hash_part("settlement_ref").alias("part")
    )


@dataclass
class DeltaStore:
    """The state of rule runs in a folder. `apply` takes what has come in; `failing` is what fails now."""

    spark: SparkSession
    folder: str
    rules: list[Rule]
    limits: Limits = Limits()
    hours: int = HOURS  # the same for all runs of a store
    tables: dict[str, Parts] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.rules = [rule for rule in self.rules if rule.active]
        other = [rule.rule_code for rule in self.rules if rule.kind not in KINDS]
        if other:
            raise ValueError(f"queries, joined rules and models read all history, run them by themselves: {other}")
        for name, columns in TABLES.items():
            by = columns.split(", ")[-1].split()[0]
            self.tables[name] = Parts(self.spark, os.path.join(self.folder, name), columns, (by,)).create()

    # --- what the families share

    def _span(self, step: Column) -> Column:
        """The part by time that an hour lies in."""
        return F.coalesce(F.floor(step / self.hours), F.lit(NO_HOUR))

    def _one(self, kind: str) -> Rule | None:
        return next((rule for rule in self.rules if rule.kind == kind), None)

    def _codes(self, kind: str) -> dict[str, int]:
        return {rule.rule_code: rule.rule_id for rule in self.rules if rule.kind == kind}

    def _pairs(self, rows: DataFrame, rule_id: int, fails: bool = True) -> DataFrame:
        return rows.select(F.lit(rule_id).alias("rule_id"), "txn_id", F.lit(fails).alias("fails"))

    def _verdicts(self, rows: DataFrame, codes: dict[str, int], tests: dict[str, tuple[str, bool]]) -> DataFrame:
        """The changes that tests on each row tell, in one pass over them: a test and whether rows that meet it fail."""
        found = [
            F.when(F.expr(test), F.struct(F.lit(codes[code]).alias("rule_id"), F.lit(fails).alias("fails")))
            for code, (test, fails) in tests.items() if code in codes
        ]
        return rows.select(F.explode(F.array(*found)).alias("v"), "txn_id").where("v IS NOT NULL").select("v.rule_id", "txn_id", "v.fails")

    def _with_old(self, table: str, fresh: DataFrame) -> DataFrame:
        """The new rows of a table and the old ones of their parts, marked `fresh`."""
        old = self.tables[table].read(values(fresh, "part"))
        return fresh.withColumn("fresh", F.lit(True)).unionByName(old.withColumn("fresh", F.lit(False)))

    def _now(self, rule_ids: Iterable[int]) -> DataFrame:
        log = self.tables["failing"].read(rule_ids)
        return log.groupBy("rule_id", "txn_id").agg(F.max_by("fails", "run").alias("fails")).where("fails")

    def _replaced(self, rule_id: int, found: DataFrame) -> DataFrame:
        """The changes that make the found transactions the ones that fail."""
        before = self._now([rule_id]).select("txn_id", F.lit(False).alias("fails"))
        both = found.select("txn_id", F.lit(True).alias("fails")).unionByName(before)
        return both.groupBy("txn_id").agg(F.max("fails").alias("fails")).select(F.lit(rule_id).alias("rule_id"), "txn_id", "fails")

    # --- families: what each changes

    def _rows(self, fact: DataFrame, as_of: datetime) -> list[DataFrame]:
        """Predicates see the new rows only; those that name the time of the run see all that may now differ."""
        rules = [rule for rule in self.rules if rule.kind == ROW]
        timed = [rule for rule in rules if with_moment(rule.rule_sql, "") != rule.rule_sql]
        plain = [rule for rule in rules if rule not in timed]
        changes = [row_hits(fact, plain, as_of).withColumn("fails", F.lit(True))] if plain else []
        for rule in timed:  # the time is pushed down to the files' bounds
            hits = row_hits(self.tables["fact"].read().drop("part"), [rule], as_of)
            changes.append(self._replaced(rule.rule_id, hits))
        return changes

    def _copies(self, fact: DataFrame) -> list[DataFrame]:
        """A new first row makes the old one a copy; new rows are copies of any first before them."""
        rule = self._one(COPIES)
        fresh, _ = settle(
            fact.groupBy(*BUSINESS_KEY).agg(F.min("txn_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
            .withColumn("part", self._span(F.col("step")))
        )
        merged, _ = settle(
            self._with_old("copies", fresh).groupBy(*BUSINESS_KEY).agg(
                F.min("first_id").alias("first_id"), F.min(F.when(~F.col("fresh"), F.col("first_id"))).alias("old_id"),
                F.sum("n").alias("all"), F.sum(F.when(F.col("fresh"), F.col("n"))).alias("n"),
            ).where("n IS NOT NULL AND all > 1")
        )
        self.tables["copies"].append(fresh)
        lookup = make_lookup(merged.select(*BUSINESS_KEY, "first_id", "n"), BUSINESS_KEY, self.limits)
        later = join_back(fact.select(*BUSINESS_KEY, "txn_id"), lookup).where(KEY_TESTS[COPIES])
        ousted = merged.where("old_id > first_id").select(F.col("old_id").alias("txn_id"))
        return [self._pairs(later, rule.rule_id), self._pairs(ousted, rule.rule_id)]

    def _velocity(self, fact: DataFrame) -> list[DataFrame]:
        """New arrivals reach the cells of their hour and of some hours after; old rows there may begin to fail."""
        rule = self._one(VELOCITY)
        limit, back = int(rule.limit("arrivals")), int(rule.limit("hours_back"))
        fresh, _ = settle(
            fact.groupBy("name_dest", "step").agg(F.count(F.lit(1)).alias("n")).withColumn("part", self._span(F.col("step")))
        )
        self.tables["cells"].append(fresh)
        step = F.col("step").cast("bigint")

        def spans(first: Column, last: Column) -> list:
            """The parts of some hours around each new cell; cells without an hour have their own."""
            reach = F.sequence(self._span(first), self._span(last))
            return values(fresh.select(F.explode(F.when(step.isNull(), F.array(F.lit(NO_HOUR))).otherwise(reach)).alias("part")), "part")

        near = spans(step, step + back)  # a new arrival counts in its own hour and in those after
        dests = fresh.select(F.col("name_dest").alias("_dest")).distinct()
        # cells elsewhere in these parts may lack arrivals, but no new ones; they failed before if they do
        cells = self.tables["cells"].read(spans(step - back, step + back))
        cells = cells.join(dests, F.col("name_dest").eqNullSafe(F.col("_dest")), "left_semi")
        busy = busy_cells(cells.groupBy("name_dest", "step").agg(F.sum("n").alias("n")), limit, back)
        lookup = make_lookup(busy.where(self._span(F.col("step")).isin(*near)), ("name_dest", "step"), self.limits)
        rows = self.tables["fact"].read(near).select("name_dest", "step", "txn_id")
        return [self._pairs(join_back(rows, lookup), rule.rule_id)]

    def _outliers(self, fact: DataFrame) -> list[DataFrame]:
        """New amounts move the ceilings; what is over them now is read from the parts of large amounts."""
        rule = self._one(OUTLIER)
        self.tables["moments"].append(amount_moments(fact).withColumn("part", F.lit(0)))
        sums = self.tables["moments"].read().groupBy("type").agg(*[F.sum(c).alias(c) for c in MOMENTS])
        ceilings, seen = settle(outlier_ceilings(sums, rule.limit("deviations")), F.min(size_of(F.col("ceiling"))).alias("size"))
        self.tables["amounts"].append(
            fact.where("amount IS NOT NULL").select("type", "amount", "txn_id", size_of(F.col("amount")).alias("part"))
        )
        if not seen["rows"]:
            return []
        high = self.tables["amounts"].read().where(F.col("part") >= seen["size"])
        found = join_back(high.drop("part"), make_lookup(ceilings, ("type",), self.limits)).where(KEY_TESTS[OUTLIER])
        return [self._replaced(rule.rule_id, found)]

    def _settlements(self, fact: DataFrame | None, settlements: DataFrame | None) -> list[DataFrame]:
        """Both feeds are folded by id; an id fails or not by what is known of both, before and after."""
        codes = self._codes(SETTLEMENT)
        shape = [c.split()[0] for c in TABLES["settled"].split(", ")[:-1]]
        sides = []
        if fact is not None:
            sides.append(fact.groupBy("txn_id").agg(
                F.min("amount").alias("low"), F.max("amount").alias("high"), F.min("txn_ts").alias("first_ts"), F.count(F.lit(1)).alias("rows")
            ))
        if settlements is not None:
            sides.append(folded_settlements(settlements))
        types = self.spark.createDataFrame([], TABLES["settled"]).schema
        sides = [
            side.select(*[F.col(c) if c in side.columns else F.lit(None).cast(types[c].dataType).alias(c) for c in shape]) for side in sides
        ]
        fresh, _ = settle(stacked(sides).withColumn("part", band_of("txn_id", BAND)))
        both = self._with_old("settled", fresh)
        fold = {"low": F.min, "high": F.max, "first_ts": F.min, "rows": F.sum, "least": F.min, "most": F.max, "latest": F.max, "settlements": F.sum}
        old = ~F.col("fresh")
        merged = both.groupBy("txn_id").agg(
            F.max("fresh").alias("fresh"), *[how(c).alias(c) for c, how in fold.items()],
            *[how(F.when(old, F.col(c))).alias(f"old_{c}") for c, how in fold.items()],
        ).where("fresh")
        late = next((int(r.limit("days")) for r in self.rules if r.rule_code == "LATE_SETTLEMENT"), 0)

        def tests(p: str) -> dict[str, Column]:
            low, high, least, most = (F.col(p + c) for c in ("low", "high", "least", "most"))
            booked = F.col(p + "rows") > 0
            differs = (low != least) | (low != most) | (high != least) | (high != most)
            found = {
                "SETTLEMENT_MISSING": F.col(p + "settlements").isNull(),
                "SETTLEMENT_AMOUNT_DIFF": differs,
                "LATE_SETTLEMENT": F.col(p + "latest") > F.date_add(F.to_date(F.col(p + "first_ts")), late),
            }
            return {code: F.coalesce(booked & test, F.lit(False)) for code, test in found.items()}

        before, after = tests("old_"), tests("")
        verdicts = [
            F.when(before[code] != after[code], F.struct(F.lit(rule_id).alias("rule_id"), after[code].alias("fails"))) for code, rule_id in codes.items()
        ]
        changes, _ = settle(
            merged.select("txn_id", F.explode(F.array(*verdicts)).alias("v")).where("v IS NOT NULL").select("v.rule_id", "txn_id", "v.fails")
        )
        self.tables["settled"].append(fresh)
        return [changes]

    def _references(self, settlements: DataFrame) -> list[DataFrame]:
        """All settlements of a reference fail but its first; a new first makes the old one fail."""
        rule = self._one(REFERENCE)
        fresh, _ = settle(folded_references(settlements))
        both = self._with_old("references", fresh)
        # several runs may know the same first id: its copies add up
        firsts = both.groupBy("settlement_ref", "first_id").agg(
            F.sum("firsts").alias("firsts"), F.sum("n").alias("n"), F.max("fresh").alias("fresh"),
            F.sum(F.when(F.col("fresh"), F.col("n"))).alias("new"), F.max(~F.col("fresh")).alias("old"),
        )
        old_first = F.min(F.when(F.col("old"), F.struct(F.col("first_id").isNull().alias("none"), F.col("first_id").alias("id"))))
        merged, _ = settle(
            firsts.groupBy("settlement_ref").agg(
                _first("first_id", "firsts").alias("first"), old_first.alias("old"), F.sum("n").alias("all"), F.sum("new").alias("n")
            )
            .where("n IS NOT NULL AND all > 1")
            .selectExpr("settlement_ref", "first.id AS first_id", "first.n AS firsts", "old IS NOT NULL AS had", "old.id AS old_id", "n")
        )
        self.tables["references"].append(fresh)
        ousted = merged.where("had AND NOT old_id <=> first_id").select(F.col("old_id").alias("txn_id"))
        twice = merged.where("firsts > 1").select(F.col("first_id").alias("txn_id"))
        lookup = make_lookup(merged.select("settlement_ref", "first_id", "n"), ("settlement_ref",), self.limits)
        later = join_back(settlements.select("settlement_ref", "txn_id"), lookup).where("NOT txn_id <=> first_id")
        return [self._pairs(x, rule.rule_id) for x in (later, ousted, twice)]

    def _accounts(self, fact: DataFrame | None, customer_master: DataFrame | None) -> list[DataFrame]:
        """New rows are checked against the accounts; rows of accounts that come in or repeat are looked up."""
        codes = self._codes(ACCOUNT)
        tests = {"ORPHAN_ORIG": ("orphan AND origin", True), "ORPHAN_DEST": ("orphan AND NOT origin", True), "DUP_CUSTOMER_MASTER": ("repeated", True)}
        accounts, parties = self.tables["accounts"], self.tables["parties"]
        changes = []
        if customer_master is not None:
            fresh, _ = settle(
                customer_master.where("account_id IS NOT NULL").groupBy(F.col("account_id").alias("account"))
                .agg(F.count(F.lit(1)).alias("copies")).withColumn("part", hash_part("account"))
            )
            merged, _ = settle(
                self._with_old("accounts", fresh).groupBy("account", "part").agg(
                    F.max("fresh").alias("fresh"), F.sum("copies").alias("copies"), F.sum(F.when(~F.col("fresh"), F.col("copies"))).alias("old")
                ).where("fresh").selectExpr("account", "part", "old IS NULL AS known", "copies > 1 AND coalesce(old, 0) <= 1 AS repeated")
                .where("known OR repeated")
            )
            accounts.append(fresh)
            held = parties.read(values(merged, "part")).drop("part")
            counts = held.groupBy("account").agg(F.count(F.lit(1)).alias("n"))
            lookup = make_lookup(merged.drop("part").join(counts, "account"), ("account",), self.limits)
            met = join_back(held, lookup)
            ends = {"ORPHAN_ORIG": ("known AND origin", False), "ORPHAN_DEST": ("known AND NOT origin", False), "DUP_CUSTOMER_MASTER": ("repeated", True)}
            changes = [settle(self._verdicts(met, codes, ends))[0]]  # before the parties of this run come in
        if fact is not None:
            sides = [F.struct(F.col(c).alias("account"), F.lit(c == "name_orig").alias("origin")) for c in ("name_orig", "name_dest")]
            rows = fact.select("txn_id", F.explode(F.array(*sides)).alias("side")).select("side.*", "txn_id").where("account IS NOT NULL")
            used = accounts_in_use(fact).withColumn("part", hash_part("account"))
            known = accounts.read().groupBy("account").agg(F.sum("copies").alias("copies"))
            found = used.drop("part").join(known, "account", "left").select("account", "n", *account_flags(F.col("copies")))
            lookup = make_lookup(found.where("orphan OR repeated"), ("account",), self.limits)
            changes.append(self._verdicts(join_back(rows, lookup), codes, tests))
            parties.append(rows.withColumn("part", hash_part("account")))
        return changes

    # --- a run

    def apply(
        self,
        run: int,
        as_of: datetime,
        fact: DataFrame | None = None,
        settlements: DataFrame | None = None,
        customer_master: DataFrame | None = None,
    ) -> DataFrame:
        """Take in new rows and return the changes (rule_id, txn_id, fails), written; a change may repeat what was so.

        `run` numbers the runs in their order. What comes in is read several times, so pass written tables.
        Without new rows only the rules that name the time of the run can change.
        """
        if fact is not None:
            self.tables["fact"].append(fact.withColumn("part", self._span(F.col("step"))))
        kinds = {rule.kind for rule in self.rules}
        booked, paid = fact is not None, settlements is not None
        jobs: dict[str, tuple[bool, Callable[[], list[DataFrame]]]] = {
            ROW: (True, lambda: self._rows(self.tables["fact"].read([]) if fact is None else fact, as_of)),
            COPIES: (booked, lambda: self._copies(fact)),
            VELOCITY: (booked, lambda: self._velocity(fact)),
            OUTLIER: (booked, lambda: self._outliers(fact)),
            SETTLEMENT: (booked or paid, lambda: self._settlements(fact, settlements)),
            REFERENCE: (paid, lambda: self._references(settlements)),
            ACCOUNT: (booked or customer_master is not None, lambda: self._accounts(fact, customer_master)),
        }
        wanted = [job for kind, (due, job) in jobs.items() if due and kind in kinds]
        inherit = inheritable_thread_target(self.spark)
        with ThreadPoolExecutor(max(1, len(wanted))) as pool:  # families do not depend on each other
            found = [change for changes in pool.map(inherit(lambda job: job()), wanted) for change in changes]
        if not found:
            found = [self.spark.createDataFrame([], "rule_id int, txn_id bigint, fails boolean")]
        changes, _ = settle(stacked(found).groupBy("rule_id", "txn_id").agg(F.max("fails").alias("fails")))
        self.tables["failing"].append(changes.withColumn("run", F.lit(run)))
        return changes

    def failing(self) -> DataFrame:
        """(rule_id, txn_id) of all that fails after the runs so far: what `rules.failing` gives on all rows."""
        return self._now([rule.rule_id for rule in self.rules]).select("rule_id", "txn_id")
