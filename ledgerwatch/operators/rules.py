"""Running the catalog: which transactions break which rules.

Rules on one row share one scan. The rules that compare rows are first reduced to
findings about keys (an account, a business key, an hour at a destination, a type):
aggregates that fold before they shuffle, so a key held by a third of the rows costs
no more than another. Findings that fit a checked bound are broadcast into that same
scan; larger ones are joined back with their heaviest keys split off. Only the
settlement rules move the fact, by its own id.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime
from decimal import Decimal
from fractions import Fraction

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.functions.lookups import (
    Limits,
    Lookup,
    attach,
    heaviest,
    join_back,
    make_lookup,
)
from ledgerwatch.operators.catalog import (
    ACCOUNT,
    COPIES,
    DIMENSION_KEYS,
    JOINED,
    MODEL,
    OUTLIER,
    QUERY,
    REFERENCE,
    ROW,
    SETTLEMENT,
    VELOCITY,
    Rule,
)
from ledgerwatch.operators.queue import utc
from ledgerwatch.operators.warehouse import Warehouse, dim_time, dim_txn_type
from ledgerwatch.session import settle

BUSINESS_KEY = ("name_orig", "name_dest", "amount", "step", "type")

# a string literal, a quoted name, or the parameter
QUOTED = r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`"
QUOTED_OR_MOMENT = re.compile(rf"{QUOTED}|:as_of\b")

VELOCITY_BLOCK = 1024  # hours in one window group


CODES_AT_ONCE = 20  # rules in one projection; the generated code of many more is not compiled


def _tagged(df: DataFrame, codes: list[Column]) -> DataFrame:
    """One (rule_id, txn_id) row per set code of each row; unset codes are NULL.

    Long lists are cut into several scans, since one projection of them all would be interpreted.
    """
    chunks = range(0, len(codes), CODES_AT_ONCE)
    return _stacked(
        [
            df.select(F.explode(F.array(*codes[k : k + CODES_AT_ONCE])).alias("rule_id"), "txn_id")
            for k in chunks
        ]
    ).where("rule_id IS NOT NULL")


def _stacked(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _code(rules: dict[str, Rule], rule_code: str, condition: Column) -> Column:
    return F.when(condition, F.lit(rules[rule_code].rule_id))


def predicate(rule: Rule, as_of: datetime) -> Column:
    return F.expr(with_moment(rule.rule_sql, _moment(as_of)))


def _moment(as_of: datetime) -> str:
    return f"TIMESTAMP_NTZ '{utc(as_of):%Y-%m-%d %H:%M:%S.%f}'"


def renamed_table(text: str, table: str, name: str) -> str:
    """The text with `table.` as `name.`, but for what stands in quotes."""
    pattern = re.compile(rf"{QUOTED}|\b{table}\s*\.")
    return pattern.sub(lambda m: f"{name}." if m[0][0] not in "'\"`" else m[0], text)


def with_moment(text: str, moment: str) -> str:
    """The text with `:as_of` replaced, but for what stands in quotes."""
    return QUOTED_OR_MOMENT.sub(lambda m: m[0] if m[0] != ":as_of" else moment, text)


def row_hits(fact: DataFrame, rules: Iterable[Rule], as_of: datetime) -> DataFrame:
    """(rule_id, txn_id) of the rules on one row: a projection, so it also runs on a stream."""
    codes = [F.when(predicate(rule, as_of), F.lit(rule.rule_id)) for rule in rules]
    return _tagged(fact, codes)


# --- findings about keys ------------------------------------------------------------


def accounts_in_use(fact: DataFrame) -> DataFrame:
    """Accounts of either side, with the number of rows they are in."""
    return (
        fact.select(F.explode(F.array("name_orig", "name_dest")).alias("account"))
        .where("account IS NOT NULL")
        .groupBy("account")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def account_flags(copies: Column) -> list[Column]:
    """What an account in use is short of, by the rows that the master has for it (NULL is none)."""
    return [
        (F.col("account").startswith("C") & copies.isNull()).alias("orphan"),
        F.coalesce(copies > 1, F.lit(False)).alias("repeated"),
    ]


def account_findings(wh: Warehouse) -> DataFrame:
    """Accounts in use that the customer dimension lacks or the master repeats.

    All three inputs are folded to one row per account first, so the joins need no
    further shuffle and meet no hot key.
    """
    used = accounts_in_use(wh.fact)
    known = wh.dim_customer.groupBy(F.col("account_id").alias("account")).agg(
        F.lit(True).alias("known")
    )
    repeated = (
        wh.customer_master.groupBy(F.col("account_id").alias("account"))
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )
    return (
        used.join(known, "account", "left")
        .join(repeated, "account", "left")
        .select(
            "account",
            "n",
            (F.col("account").startswith("C") & F.col("known").isNull()).alias("orphan"),
            F.col("copies").isNotNull().alias("repeated"),
        )
        .where("orphan OR repeated")
    )


def copy_findings(fact: DataFrame) -> DataFrame:
    """Business keys used more than once, with the first transaction that used them.

    Hardly any key repeats, so folding before the shuffle saves nothing. Hashes of the key are
    counted first; only rows whose hash comes twice are shuffled with their key.
    """
    hashed = fact.select(*BUSINESS_KEY, "txn_id", F.xxhash64(*BUSINESS_KEY).alias("_hash"))
    twice = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    return (
        hashed.join(twice.select("_hash"), "_hash", "left_semi")
        .groupBy(*BUSINESS_KEY)
        .agg(F.min("txn_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def reference_findings(settlements: DataFrame) -> DataFrame:
    return (
        settlements.groupBy("settlement_ref")
        .agg(F.min("txn_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


LIMB = 10**9  # amounts in cents are cut into two limbs, so that products fit a long


def amount_moments(fact: DataFrame) -> DataFrame:
    """Exact power sums of the amounts of each type, in cents: rows that add up over parts of a table.

    An amount is a * 10^9 + b cents. Sums of a*a, a*b and b*b hold the sum of squares in whole numbers
    for more rows than any table has, whatever the amounts.
    """
    cents = (F.col("amount") * 100).cast("bigint")
    wide = "decimal(28,0)"
    return (
        fact.select("type", cents.alias("_c"))
        .select("type", "_c", F.expr(f"_c div {LIMB}L").alias("_a"), (F.col("_c") % F.lit(LIMB)).alias("_b"))
        .groupBy("type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("_c").alias("amounts"),
            F.sum(F.col("_c").cast(wide)).alias("s"),
            F.sum((F.col("_a") * F.col("_a")).cast(wide)).alias("aa"),
            F.sum((F.col("_a") * F.col("_b")).cast(wide)).alias("ab"),
            F.sum((F.col("_b") * F.col("_b")).cast(wide)).alias("bb"),
        )
    )


MOMENTS = ("n", "amounts", "s", "aa", "ab", "bb")


def highest_ordinary(amounts: int, total: int, squares: int, deviations: Fraction) -> int:
    """The highest whole x that is not over mean + deviations * sample deviation, in integers alone.

    x is over it exactly if n x - total > sqrt(deviations^2 n (n squares - total^2) / (n - 1)).
    """
    spread = deviations**2 * amounts * (amounts * squares - total * total) / (amounts - 1)
    return (total + math.isqrt(math.floor(spread))) // amounts


def outlier_ceilings(moments: DataFrame, deviations: float) -> DataFrame:
    """(type, ceiling, n): the highest ordinary amount of each type; one amount alone has no ceiling."""
    times = Fraction(str(deviations))

    def ceilings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # a row for each type
            rows = []
            for r in batch.to_pylist():
                n, s, aa, ab, bb = (int(r[c]) for c in MOMENTS[1:])
                top = highest_ordinary(n, s, aa * LIMB**2 + 2 * ab * LIMB + bb, times)
                rows.append({"type": r["type"], "ceiling": Decimal(top).scaleb(-2), "n": r["n"]})
            yield pa.RecordBatch.from_pylist(rows, schema=_CEILINGS)

    return moments.where("amounts > 1").mapInArrow(ceilings, "type string, ceiling decimal(38,2), n bigint")


_CEILINGS = pa.schema([("type", pa.string()), ("ceiling", pa.decimal128(38, 2)), ("n", pa.int64())])


def outlier_findings(fact: DataFrame, deviations: float) -> DataFrame:
    return outlier_ceilings(amount_moments(fact), deviations)


def velocity_findings(fact: DataFrame, limit: int, back: int) -> DataFrame:
    """(destination, hour) cells with more than `limit` arrivals in that hour and the `back` before.

    Arrivals are counted per cell first. The frame then runs over blocks of hours, each
    with the last hours of the block before copied in, so a group has a fixed size
    however long a destination's history is. Rows without an hour are peers of each other
    alone.
    """
    return busy_cells(fact.groupBy("name_dest", "step").agg(F.count(F.lit(1)).alias("n")), limit, back)


def busy_cells(cells: DataFrame, limit: int, back: int) -> DataFrame:
    """The cells (name_dest, step, n) over the limit, with their arrivals."""
    if not 0 <= back < VELOCITY_BLOCK:
        raise ValueError(f"hours_back must be under {VELOCITY_BLOCK}")
    block = F.floor(F.col("step") / VELOCITY_BLOCK)
    late = F.pmod(F.col("step"), F.lit(VELOCITY_BLOCK)) >= VELOCITY_BLOCK - back
    blocks = F.when(late, F.array(block, block + 1)).otherwise(F.array(block))
    frame = (
        Window.partitionBy("name_dest", "_block")
        .orderBy(F.col("step").cast("bigint"))
        .rangeBetween(-back, Window.currentRow)
    )
    return (
        cells.withColumn("_own", block)
        .withColumn("_block", F.explode(blocks))
        .withColumn("arrivals", F.sum("n").over(frame))
        .where(F.col("_block").eqNullSafe(F.col("_own")) & (F.col("arrivals") > limit))
        .select("name_dest", "step", "n", "arrivals")
    )


# --- rule families ------------------------------------------------------------------


def settlement_hits(wh: Warehouse, rules: dict[str, Rule]) -> DataFrame:
    """Missing, differing and late settlements from one join.

    Settlements are folded to one row per transaction: some amount differs if the least
    or the greatest does, and some date is late if the latest is.
    """
    settled = (
        wh.settlements.where("txn_id IS NOT NULL")
        .groupBy("txn_id")
        .agg(
            F.min("settled_amount").alias("least"),
            F.max("settled_amount").alias("most"),
            F.max("settlement_date").alias("latest"),
            F.lit(True).alias("settled"),
        )
    )
    joined = wh.fact.select("txn_id", "amount", "txn_ts").join(settled, "txn_id", "left")
    differs = (F.col("amount") != F.col("least")) | (F.col("amount") != F.col("most"))
    days = int(rules["LATE_SETTLEMENT"].limit("days")) if "LATE_SETTLEMENT" in rules else 0
    due = F.date_add(F.to_date("txn_ts"), days)
    tests = {
        "SETTLEMENT_MISSING": F.col("settled").isNull(),
        "SETTLEMENT_AMOUNT_DIFF": differs,
        "LATE_SETTLEMENT": F.col("latest") > due,
    }
    return _tagged(joined, [_code(rules, code, test) for code, test in tests.items() if code in rules])


def reference_hits(wh: Warehouse, rule: Rule, lookup: Lookup) -> DataFrame:
    """Transactions of every settlement but the first under one reference.

    The first is the lowest txn_id, NULL last. If two rows share it, one of them is a repeat.
    """
    rows = join_back(wh.settlements.select("settlement_ref", "txn_id"), lookup)
    return (
        rows.groupBy("settlement_ref", "txn_id", "first_id")
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("NOT txn_id <=> first_id OR copies > 1")
        .select(F.lit(rule.rule_id).alias("rule_id"), "txn_id")
    )


def _account_hits_shuffled(wh: Warehouse, rules: dict[str, Rule], lookup: Lookup) -> DataFrame:
    sides = wh.fact.select(
        "txn_id",
        F.explode(
            F.array(
                F.struct(F.lit(True).alias("origin"), F.col("name_orig").alias("account")),
                F.struct(F.lit(False).alias("origin"), F.col("name_dest").alias("account")),
            )
        ).alias("side"),
    ).select("txn_id", "side.origin", "side.account").where("account IS NOT NULL")
    # most heavy accounts are in order, so they are looked for among all accounts
    heavy, _ = settle(heaviest(accounts_in_use(wh.fact), lookup.keys, lookup.limits))
    tests = {
        "ORPHAN_ORIG": F.col("orphan") & F.col("origin"),
        "ORPHAN_DEST": F.col("orphan") & ~F.col("origin"),
        "DUP_CUSTOMER_MASTER": F.col("repeated"),
    }
    codes = [_code(rules, code, test) for code, test in tests.items() if code in rules]
    return _tagged(join_back(sides, lookup, heavy), codes)


def joined_scans(
    wh: Warehouse, rules: Iterable[Rule], as_of: datetime, scan: DataFrame, limits: Limits
) -> tuple[DataFrame, list[Column], list[DataFrame]]:
    """The scan with the dimensions of the joined rules attached, their codes, and hits of what is not broadcast.

    Each pair of a dimension and a fact column is one lookup, however many rules name it.
    """
    pairs: dict[tuple[str, str], list[Rule]] = {}
    for rule in rules:
        pairs.setdefault(rule.joined()[:2], []).append(rule)
    codes, parts, held = [], [], {}
    for table in {table for table, _ in pairs}:
        key = DIMENSION_KEYS[table]
        rows = query_tables(wh)[table]().where(F.col(key).isNotNull())
        others = F.to_json(F.struct("*"))  # as text, for the measure of its size
        held[table] = make_lookup(rows.select(F.col(key).alias("_at"), F.struct("*").alias("_row"), others.alias("_text")), ("_at", "_text"), limits)
    for (table, column), mine in pairs.items():
        lookup, name = held[table], f"_{table}_{column}"
        found = lookup.frame.select(F.col("_at").alias(f"{name}_at"), F.col("_row").alias(name))
        tests = []
        for rule in mine:
            text = renamed_table(with_moment(rule.joined()[2], _moment(as_of)), table, name)
            tests.append(F.when(F.col(name).isNotNull() & F.expr(text), F.lit(rule.rule_id)))
        if lookup.fits:
            scan = attach(scan, Lookup(found, (f"{name}_at",), True, limits), on=(column,))
            codes += tests
            continue
        counts = wh.fact.groupBy(F.col(column).alias(f"{name}_at")).agg(F.count(F.lit(1)).alias("n"))
        counted = make_lookup(found.join(counts, f"{name}_at"), (f"{name}_at",), limits)
        rows = join_back(wh.fact.withColumn(f"{name}_at", F.col(column)), counted)
        parts.append(_tagged(rows, tests))
    return scan, codes, parts


def _by_kind(rules: Iterable[Rule]) -> dict[str, dict[str, Rule]]:
    kinds: dict[str, dict[str, Rule]] = {}
    for rule in rules:
        if rule.active:
            kinds.setdefault(rule.kind, {})[rule.rule_code] = rule
    return kinds


# the test on a fact row beside the findings about its key
KEY_TESTS = {
    COPIES: "txn_id > first_id",
    OUTLIER: "amount > ceiling",
    VELOCITY: "arrivals IS NOT NULL",
}


def _lookups(
    wh: Warehouse, kinds: dict[str, dict[str, Rule]], limits: Limits
) -> dict[str, Lookup]:
    """The findings the active rules need. They do not depend on each other and run side by side."""

    def limit(kind: str, name: str) -> float:
        (rule,) = kinds[kind].values()
        return rule.limit(name)

    findings = {
        ACCOUNT: (lambda: account_findings(wh), ("account",)),
        COPIES: (lambda: copy_findings(wh.fact), BUSINESS_KEY),
        OUTLIER: (lambda: outlier_findings(wh.fact, limit(OUTLIER, "deviations")), ("type",)),
        VELOCITY: (
            lambda: velocity_findings(
                wh.fact, int(limit(VELOCITY, "arrivals")), int(limit(VELOCITY, "hours_back"))
            ),
            ("name_dest", "step"),
        ),
        REFERENCE: (lambda: reference_findings(wh.settlements), ("settlement_ref",)),
    }
    wanted = {kind: found for kind, found in findings.items() if kind in kinds}
    if not wanted:
        return {}
    inherit = inheritable_thread_target(wh.fact.sparkSession)
    with ThreadPoolExecutor(len(wanted)) as pool:
        jobs = {
            kind: pool.submit(inherit(lambda make=make, keys=keys: make_lookup(make(), keys, limits)))
            for kind, (make, keys) in wanted.items()
        }
        return {kind: job.result() for kind, job in jobs.items()}


def failing(
    wh: Warehouse, rules: Iterable[Rule], as_of: datetime, limits: Limits = Limits()
) -> DataFrame:
    """(rule_id, txn_id) of every active rule, each pair once, also if txn_id is no key."""
    return failing_pairs(wh, rules, as_of, limits).distinct()


def failing_pairs(
    wh: Warehouse, rules: Iterable[Rule], as_of: datetime, limits: Limits = Limits()
) -> DataFrame:
    """As `failing`, but a pair may come more than once; for callers that fold them anyway."""
    kinds = _by_kind(rules)
    scan, codes, parts = wh.fact, [], []
    lookups = _lookups(wh, kinds, limits)

    if kinds.get(ROW):
        parts.append(row_hits(wh.fact, kinds[ROW].values(), as_of))

    if ACCOUNT in lookups:
        wanted, lookup = kinds[ACCOUNT], lookups[ACCOUNT]
        if lookup.fits:
            for side in ("orig", "dest"):
                named = lookup.frame.select(
                    F.col("account").alias(f"_{side}"),
                    F.col("orphan").alias(f"_{side}_orphan"),
                    F.col("repeated").alias(f"_{side}_repeated"),
                )
                one_side = Lookup(named, (f"_{side}",), True, limits)
                scan = attach(scan, one_side, on=(f"name_{side}",))
            tests = {
                "ORPHAN_ORIG": F.col("_orig_orphan"),
                "ORPHAN_DEST": F.col("_dest_orphan"),
                "DUP_CUSTOMER_MASTER": F.col("_orig_repeated") | F.col("_dest_repeated"),
            }
            codes += [_code(wanted, code, test) for code, test in tests.items() if code in wanted]
        else:
            parts.append(_account_hits_shuffled(wh, wanted, lookup))

    for kind, test in KEY_TESTS.items():
        if kind not in lookups:
            continue
        lookup = lookups[kind]
        (rule,) = kinds[kind].values()
        if lookup.fits:
            scan = attach(scan, lookup)
            codes.append(F.when(F.expr(test), F.lit(rule.rule_id)))
        else:
            columns = dict.fromkeys(("txn_id", "amount", *lookup.keys))
            rows = join_back(wh.fact.select(*columns), lookup)
            hits = rows.where(F.expr(test))
            parts.append(hits.select(F.lit(rule.rule_id).alias("rule_id"), "txn_id"))

    if JOINED in kinds:
        scan, more, apart = joined_scans(wh, kinds[JOINED].values(), as_of, scan, limits)
        codes += more
        parts += apart
    if codes:
        parts.append(_tagged(scan, codes))
    if SETTLEMENT in kinds:
        parts.append(settlement_hits(wh, kinds[SETTLEMENT]))
    for rule in kinds.get(REFERENCE, {}).values():
        parts.append(reference_hits(wh, rule, lookups[REFERENCE]))
    for rule in kinds.get(MODEL, {}).values():
        if wh.scores is None:
            raise ValueError(f"{rule.rule_code} is active but there are no scores")
        parts.append(
            wh.scores.where("is_anomaly").select(F.lit(rule.rule_id).alias("rule_id"), "txn_id")
        )
    for rule in kinds.get(QUERY, {}).values():
        parts.append(
            query_result(wh, rule.rule_sql).select(F.lit(rule.rule_id).alias("rule_id"), "txn_id")
        )
    return _union(wh, parts)


def query_result(wh: Warehouse, text: str) -> DataFrame:
    """The txn_id column of a query rule over the warehouse tables."""
    named = set(re.findall(r"\{(\w+)\}", text))
    used = {name: make() for name, make in query_tables(wh).items() if name in named}
    return wh.fact.sparkSession.sql(text, **used).select(F.col("txn_id").cast("bigint"))


def query_tables(wh: Warehouse) -> dict:
    """The tables a query rule may name in braces; the derived ones are made if they are named."""
    tables = {
        "fact": lambda: wh.fact,
        "customer_master": lambda: wh.customer_master,
        "settlements": lambda: wh.settlements,
        "dim_customer": lambda: wh.dim_customer,
        "dim_time": lambda: dim_time(wh.fact),
        "dim_txn_type": lambda: dim_txn_type(wh.fact.sparkSession),
    }
    for name in ("scores", "injected_defects"):
        if getattr(wh, name) is not None:
            tables[name] = lambda name=name: getattr(wh, name)
    return tables


def _union(wh: Warehouse, parts: list[DataFrame]) -> DataFrame:
    if not parts:
        return wh.fact.sparkSession.createDataFrame([], "rule_id int, txn_id bigint")
    return _stacked(parts)


def failing_rule(
    wh: Warehouse,
    rules: Iterable[Rule],
    rule_code: str,
    as_of: datetime,
    limits: Limits = Limits(),
) -> DataFrame:
    """The transactions that break one rule, active or not."""
    chosen = [replace(rule, active=True) for rule in rules if rule.rule_code == rule_code]
    if not chosen:
        raise KeyError(rule_code)
    return failing(wh, chosen, as_of, limits).select("txn_id")
