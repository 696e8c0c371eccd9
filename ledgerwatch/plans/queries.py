"""Every operator as a query over the test tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.operators import anomaly, defects, recall, staging
from ledgerwatch.operators import warehouse as dw
from ledgerwatch.operators.catalog import (
    SETTLEMENT,
    add_rule,
    catalog_frame,
    rules_from_frame,
    set_active,
    standard_rules,
)
from ledgerwatch.operators.delta import DeltaStore
from ledgerwatch.operators.queue import apply_updates, mark_new, new_exceptions
from ledgerwatch.operators.queue_store import QueueStore
from ledgerwatch.operators.rules import failing, failing_rule
from ledgerwatch.plans import marts
from ledgerwatch.plans import testbed as tb
from ledgerwatch.plans.run import reset_store, run_rules, score_transactions, store_pipeline
from ledgerwatch.session import scratch_root, settle
from ledgerwatch.sources import tables
from ledgerwatch.sources.parts import Parts
from ledgerwatch.sources.schemas import EXCEPTIONS, SUMMARIES

Query = Callable[[SparkSession, str], DataFrame]

RULES = standard_rules()
AS_OF = tb.AS_OF
REPORT_DATE = date(2026, 1, 20)
MATRIX_DAYS = [str(date(2026, 1, 1) + timedelta(days)) for days in range(-1, 31)]  # hours -1 to 743
LOOKUP = ("C7", 100, 200)
CUSTOM_PREDICATE = "amount > 500000 AND oldbalance_dest < newbalance_dest"
NIGHT_QUERY = (
    "SELECT f.txn_id FROM {fact} f JOIN {dim_time} t ON f.step = t.time_key"
    " JOIN {dim_txn_type} k ON f.type = k.type WHERE t.hour_of_day = 3 AND k.direction = 'CREDIT'"
)
CUSTOM_QUERY = (
    "SELECT f.txn_id FROM {fact} f JOIN {dim_customer} c ON f.name_orig = c.account_id"
    " WHERE c.kyc_status = 'REJECTED' AND f.type = 'TRANSFER'"
)


def plain(df: DataFrame) -> DataFrame:
    """Column types that every engine prints alike."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        elif isinstance(field.dataType, T.IntegralType):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def _catalog(spark: SparkSession) -> DataFrame:
    return catalog_frame(spark, RULES)


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failing(tb.warehouse(spark, sf_dir), RULES, AS_OF)


def _run(spark: SparkSession, sf_dir: str):
    return run_rules(tb.warehouse(spark, sf_dir), RULES, AS_OF)


def _scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.rule_scorecard(_run(spark, sf_dir).log, _catalog(spark))


def _daily_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = tb.warehouse(spark, sf_dir)
    return tb.daily_run_log(wh.fact, failing(wh, RULES, AS_OF), RULES)


def _daily_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.rule_scorecard(_daily_log(spark, sf_dir), _catalog(spark))


def _daily_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_control(_daily_log(spark, sf_dir), _catalog(spark))


def _aged_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue as if items had been found 0 to 9 days ago and every fourth was closed."""
    queue = _run(spark, sf_dir).exceptions
    return queue.withColumn(
        "detected_at", F.expr("detected_at - make_dt_interval(CAST(txn_id % 10 AS INT))")
    ).withColumn("status", F.expr("IF(txn_id % 4 = 0, 'RESOLVED', 'OPEN')"))


def _ageing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.exception_ageing(_aged_queue(spark, sf_dir), _catalog(spark), AS_OF)


# --- staging and defects ------------------------------------------------------------


def stage_transactions(spark, sf_dir):
    return plain(staging.stage_transactions(tb.as_text(tb.damaged(spark, sf_dir)[0])))


def stage_transactions_without_key(spark, sf_dir):
    raw = tb.as_text(tb.damaged(spark, sf_dir)[0]).drop("txn_id")
    return plain(staging.stage_transactions(raw))


def stage_customer_master(spark, sf_dir):
    raw = tb.as_text(tb.customer_master(spark, sf_dir))
    return plain(staging.stage(raw, "customer_master"))


def stage_settlements(spark, sf_dir):
    return plain(staging.stage(tb.as_text(tb.settlements(spark, sf_dir)), "settlements"))


def stage_rejects(spark, sf_dir):
    raw = tb.as_text(tb.settlements(spark, sf_dir)).withColumn(
        "settled_amount", F.expr("IF(txn_id % 50 = 0, concat(settled_amount, 'x'), settled_amount)")
    )
    good, rejected = staging.stage_with_rejects(raw, "settlements")
    total = F.sum("settled_amount").cast("double").alias("settled_total")
    counted = good.agg(F.lit("staged").alias("outcome"), F.count(F.lit(1)).alias("rows"), total)
    refused = rejected.agg(
        F.lit("rejected").alias("outcome"),
        F.count(F.lit(1)).alias("rows"),
        F.lit(None).cast("double").alias("settled_total"),
    )
    return counted.unionByName(refused)


def inject_defects(spark, sf_dir):
    return plain(tb.damaged(spark, sf_dir)[0])


def injected_defects_log(spark, sf_dir):
    return tb.damaged(spark, sf_dir)[1]


def inject_defects_other_seed(spark, sf_dir):
    """The published rates under the seed of the model."""
    clean = tb.clean_transactions(spark, sf_dir)
    return defects.inject_defects(clean, seed=anomaly.SEED, duplicate_offset=tb.COPY_OFFSET)[1]


def stage_text_feed(spark, sf_dir):
    """Settlements written as a text feed, every 50th with a field too many, and read again."""
    path = scratch_path(spark, "feed")
    long = F.when(F.col("txn_id") % 50 == 0, F.concat("settlement_date", F.lit(",more"))).otherwise(F.col("settlement_date"))
    feed = tb.as_text(tb.settlements(spark, sf_dir)).withColumn("settlement_date", long)
    feed.write.option("header", True).option("quote", "").csv(path)
    good, bad = staging.stage_with_rejects(tables.read_feed(spark, "settlements", path), "settlements")
    outcome = [F.count(F.lit(1)).alias("rows"), F.sum("settled_amount").cast("double").alias("settled_total")]
    staged = good.agg(*outcome).select(F.lit("staged").alias("outcome"), "*")
    rejected = bad.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("rejected").alias("outcome"), "rows", F.lit(None).cast("double").alias("settled_total")
    )
    return plain(staged.unionByName(rejected))


def inject_defects_overlapping(spark, sf_dir):
    """Copies drawn by themselves, and then originals and copies damaged alike."""
    clean = tb.clean_transactions(spark, sf_dir)
    return defects.inject_defects(clean, seed=anomaly.SEED, duplicate_offset=tb.COPY_OFFSET, exclusive=False)[1]


def feed_round_trip(spark, sf_dir):
    """Transactions written as a text feed by the sink, read by the source and typed."""
    path = scratch_path(spark, "feed")
    tables.write_feed(tb.as_text(tb.damaged(spark, sf_dir)[0]), path)
    return plain(staging.stage_transactions(tables.read_feed(spark, "transactions", path, keyed=True)))


def defect_counts(spark, sf_dir):
    return defects.defect_counts(tb.damaged(spark, sf_dir)[1])


# --- warehouse ----------------------------------------------------------------------


def dim_customer(spark, sf_dir):
    return plain(dw.dim_customer(tb.customer_master(spark, sf_dir)))


def dim_txn_type(spark, sf_dir):
    """The literal members, beside how often the fact uses them."""
    used = tb.warehouse(spark, sf_dir).fact.groupBy("type").agg(F.count(F.lit(1)).alias("txns"))
    return plain(
        dw.dim_txn_type(spark)
        .join(used, "type", "left")
        .select("type_id", "type", "direction", F.coalesce("txns", F.lit(0)).alias("txns"))
    )


def dim_time(spark, sf_dir):
    return plain(dw.dim_time(tb.damaged(spark, sf_dir)[0]))


def fact_transactions(spark, sf_dir):
    return plain(tb.warehouse(spark, sf_dir).fact)


def pk_violations(spark, sf_dir):
    wh = tb.warehouse(spark, sf_dir)
    checks = (
        (wh.dim_customer, "account_id", "dim_customer"),
        (dw.dim_time(tb.damaged(spark, sf_dir)[0]), "time_key", "dim_time"),
        (wh.fact, "txn_id", "fact_transactions"),
        (wh.customer_master, "account_id", "customer_master"),
        (wh.settlements, "settlement_ref", "settlements"),
    )
    found = [dw.key_violations(df, key, name) for df, key, name in checks]
    result = found[0]
    for part in found[1:]:
        result = result.unionByName(part)
    return result


def catalog_violations(spark, sf_dir):
    """A catalog with a bad severity and a repeated code, against the queue of the full one."""
    broken = _catalog(spark).where("rule_id <> 17").select(
        "rule_id",
        F.expr("IF(rule_id = 3, 'NULL_TYPE', rule_code)").alias("rule_code"),
        F.expr("IF(rule_id = 5, 'SEVERE', severity)").alias("severity"),
    )
    return dw.catalog_violations(broken, _run(spark, sf_dir).exceptions)


def account_universe(spark, sf_dir):
    return dw.account_universe(tb.damaged(spark, sf_dir)[0])


def star_join_daily(spark, sf_dir):
    wh = tb.warehouse(spark, sf_dir)
    return plain(dw.star_join_daily(wh.fact, wh.dim_customer, spark))


# --- rules and queue ----------------------------------------------------------------


def rule_catalog(spark, sf_dir):
    """The catalog, beside the number of failing transactions of each rule."""
    counts = _hits(spark, sf_dir).groupBy("rule_id").agg(F.count(F.lit(1)).alias("failing"))
    return plain(
        _catalog(spark)
        .join(counts, "rule_id", "left")
        .select(
            "rule_id",
            "rule_code",
            "dimension",
            "severity",
            "active",
            F.coalesce("failing", F.lit(0)).alias("failing"),
        )
    )


def _rule(rule_code: str) -> Query:
    def query(spark, sf_dir):
        return failing_rule(tb.warehouse(spark, sf_dir), RULES, rule_code, AS_OF)

    return query


def rule_anomaly_iforest(spark, sf_dir):
    wh = tb.warehouse(spark, sf_dir)
    wh = replace(wh, scores=score_transactions(wh))
    return failing_rule(wh, RULES, "ANOMALY_IFOREST", AS_OF)


def all_exceptions(spark, sf_dir):
    named = _catalog(spark).select("rule_id", "rule_code")
    return _hits(spark, sf_dir).join(named, "rule_id").select("rule_code", "txn_id")


def exceptions(spark, sf_dir):
    return plain(_run(spark, sf_dir).exceptions.drop("exception_id"))


def _earlier_queue(spark, sf_dir):
    """What a run a day earlier would have queued had only even transactions been there."""
    before = failing(tb.warehouse(spark, sf_dir), RULES, AS_OF).where("txn_id % 2 = 0")
    return new_exceptions(mark_new(before, None), datetime(2026, 1, 19))


def exceptions_incremental(spark, sf_dir):
    wh, queue = tb.warehouse(spark, sf_dir), _earlier_queue(spark, sf_dir)
    return run_rules(wh, RULES, AS_OF, queue=queue).exceptions.select("rule_id", "txn_id").transform(
        plain
    )


CUTS = 10


def _in_cuts(rows: DataFrame, *key: str) -> Parts:
    """The rows in parts by cut, so that a run opens the files of its own."""
    spark = rows.sparkSession
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    cuts = Parts(spark, scratch_path(spark, "cuts"), f"{columns}, part bigint").create()
    cuts.append(rows.withColumn("part", F.pmod(F.xxhash64(*key), F.lit(CUTS))))
    return cuts


def exceptions_by_delta(spark, sf_dir):
    """All rules over ten cuts of the three feeds as they come in, late settlements and accounts among them."""
    wh = tb.warehouse(spark, sf_dir)
    fact, paid = _in_cuts(wh.fact, "txn_id"), _in_cuts(wh.settlements, "settlement_ref", "txn_id")
    master = _in_cuts(wh.customer_master, "account_id", "opened_date")
    store = DeltaStore(spark, scratch_path(spark, "delta"), RULES, hours=168)
    for k in range(CUTS):
        mine = [cuts.read([k]).drop("part") for cuts in (fact, paid)]
        # accounts come in three times, so that rows wait for theirs
        some = master.read([j for j in range(CUTS) if j % 3 == k // 4]).drop("part") if k % 4 == 0 else None
        store.apply(k, AS_OF, *mine, some)
    return plain(store.failing())


def stored_queue(spark, sf_dir):
    """Two runs into a stored queue: the items with the time of the run that queued them."""
    store = QueueStore.at(spark, scratch_path(spark, "queue"))
    found, _ = settle(_hits(spark, sf_dir))
    store.insert(found.where("txn_id % 2 = 0"), datetime(2026, 1, 19))
    store.insert(found, AS_OF)
    return plain(store.read().select("rule_id", "txn_id", "detected_at", "status"))


def stored_open_queue(spark, sf_dir):
    """The open items of a stored queue after analysts closed every fourth and took up every tenth."""
    store = QueueStore.at(spark, scratch_path(spark, "queue"), width=4096)
    found, _ = settle(_hits(spark, sf_dir))
    store.insert(found, AS_OF)
    sent = found.where("txn_id < 8192 AND (txn_id % 4 = 0 OR txn_id % 10 = 0)").selectExpr(
        "rule_id", "txn_id", "IF(txn_id % 4 = 0, 'RESOLVED', 'ASSIGNED') AS status", "'ann' AS assigned_to",
        "CAST(NULL AS STRING) AS note", "TIMESTAMP '2026-01-21 09:00:00' AS updated_at",
    )
    store.update(sent)
    return plain(store.open_items().select("rule_id", "txn_id"))


def run_log_query(spark, sf_dir):
    return plain(_run(spark, sf_dir).log.drop("run_id"))


def run_log_second_run(spark, sf_dir):
    """A run on a queue that holds half of the findings: new and failing counts differ."""
    wh, queue = tb.warehouse(spark, sf_dir), _earlier_queue(spark, sf_dir)
    return plain(run_rules(wh, RULES, AS_OF, queue=queue).log.drop("run_id"))


def exception_lifecycle(spark, sf_dir):
    """Every tenth item is taken up, every twentieth closed, and some moves are not allowed."""
    queue = _run(spark, sf_dir).exceptions
    picked = queue.where("txn_id % 10 = 0").select("rule_id", "txn_id")
    taken = picked.selectExpr(
        "rule_id",
        "txn_id",
        "'ASSIGNED' AS status",
        "concat('analyst', txn_id % 3) AS assigned_to",
        "CAST(NULL AS STRING) AS note",
        "TIMESTAMP '2026-01-21 09:00:00' AS updated_at",
    )
    closed = picked.where("txn_id % 20 = 0").selectExpr(
        "rule_id",
        "txn_id",
        "'RESOLVED' AS status",
        "CAST(NULL AS STRING) AS assigned_to",
        "'explained' AS note",
        "TIMESTAMP '2026-01-22 09:00:00' AS updated_at",
    )
    reopened = picked.where("txn_id % 40 = 0").selectExpr(
        "rule_id",
        "txn_id",
        "'OPEN' AS status",
        "CAST(NULL AS STRING) AS assigned_to",
        "'again' AS note",
        "TIMESTAMP '2026-01-23 09:00:00' AS updated_at",
    )
    updates = taken.unionByName(closed).unionByName(reopened)
    return plain(apply_updates(settle(queue)[0], updates).drop("exception_id"))


def custom_sql_rule(spark, sf_dir):
    rules = add_rule(
        RULES, "LARGE_CREDIT", "Validity", "LOW", "Large credit", predicate=CUSTOM_PREDICATE
    )
    rules = add_rule(
        rules, "REJECTED_SENDER", "Integrity", "HIGH", "Rejected sender", query=CUSTOM_QUERY
    )
    rules = add_rule(
        rules, "NIGHT_CREDIT", "Validity", "LOW", "Credit at night", query=NIGHT_QUERY
    )
    wh = tb.warehouse(spark, sf_dir)
    return plain(failing(wh, rules[-3:], AS_OF))


def forty_user_rules(spark, sf_dir):
    """More predicates than one generated projection can hold."""
    rules = RULES
    for k in range(40):
        text = f"amount > {k * 1000} AND step % 40 = {k}"
        rules = add_rule(rules, f"USER_{k}", "Validity", "LOW", "A user's rule", predicate=text)
    return plain(failing(tb.warehouse(spark, sf_dir), rules[len(RULES):], AS_OF))


def _joined_rules() -> list:
    """Twenty rules over three dimensions and both accounts."""
    rules = RULES
    for k, (status, kind) in enumerate((s, t) for s in ("REJECTED", "EXPIRED", "PENDING") for t in ("TRANSFER", "CASH_OUT")):
        text = f"dim_customer.kyc_status = '{status}' AND type = '{kind}'"
        for side in ("name_orig", "name_dest"):
            rules = add_rule(rules, f"{side.upper()}_{k}", "Integrity", "HIGH", "Status of a party", predicate=text, joined=("dim_customer", side))
    for hour in (2, 3, 4, 5):
        text = f"dim_time.hour_of_day = {hour} AND amount > 100000"
        rules = add_rule(rules, f"NIGHT_{hour}", "Validity", "LOW", "Large at night", predicate=text, joined=("dim_time", "step"))
    for k in range(4):
        text = f"dim_txn_type.direction = 'CREDIT' AND newbalance_orig - oldbalance_org <> amount AND step % 4 = {k}"
        rules = add_rule(rules, f"CREDIT_{k}", "Consistency", "LOW", "Credit that does not add up", predicate=text, joined=("dim_txn_type", "type"))
    return rules[len(RULES):]


def twenty_joined_rules(spark, sf_dir):
    """Rules on a row and its dimensions, all in one scan of the fact."""
    return plain(failing(tb.warehouse(spark, sf_dir), _joined_rules(), AS_OF))


BUCKETS = 16


def settlement_rules_bucketed(spark, sf_dir):
    """The settlement rules on tables that lie in buckets of the transaction id."""
    wh = tb.warehouse(spark, sf_dir)
    stored = {}
    for name in ("fact", "settlements"):
        path, rows = scratch_path(spark, f"bucketed-{name}"), getattr(wh, name)
        tables.write_bucketed(rows, path, "txn_id", BUCKETS)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
        stored[name] = tables.read_bucketed(spark, path, columns, "txn_id", BUCKETS)
    rules = [rule for rule in RULES if rule.kind == SETTLEMENT]
    return plain(failing(replace(wh, **stored), rules, AS_OF))


def _interleaved(spark, sf_dir):
    path = scratch_path(spark, "interleaved")
    tables.write_interleaved_layout(tb.warehouse(spark, sf_dir).fact, path)
    return tables.read_table(spark, path)


def party_lookups(spark, sf_dir):
    """One layout, read by destination and hours, by origin, and by transaction."""
    fact = _interleaved(spark, sf_dir)
    found = {
        "destination": tables.party_rows(fact, "name_dest", *LOOKUP),
        "origin": tables.party_rows(fact, "name_orig", LOOKUP[0]),
        "transaction": fact.where(F.col("txn_id") == 4242),
    }
    parts = [rows.select(F.lit(name).alias("lookup"), "txn_id", "step", "amount") for name, rows in found.items()]
    return plain(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def catalog_round_trip(spark, sf_dir):
    """A stored catalog that someone edited: a limit changed, a rule off, a rule added."""
    path = scratch_path(spark, "catalog")
    fresh = add_rule(RULES, "LARGE_CREDIT", "Validity", "LOW", "Large credit", predicate=CUSTOM_PREDICATE)
    edited = catalog_frame(spark, fresh).withColumns({
        "params": F.when(F.col("rule_code") == "AMOUNT_ZSCORE_BY_TYPE", F.create_map(F.lit("deviations"), F.lit(3.0)))
        .otherwise(F.col("params")),
        "active": F.col("active") & (F.col("rule_code") != "SELF_TRANSFER"),
    })
    tables.replace_table(edited, path)
    rules = rules_from_frame(tables.read_table(spark, path))
    chosen = ("AMOUNT_ZSCORE_BY_TYPE", "SELF_TRANSFER", "LARGE_CREDIT", "NEG_AMOUNT")
    return plain(failing(tb.warehouse(spark, sf_dir), [r for r in rules if r.rule_code in chosen], AS_OF))


def recall_literal(spark, sf_dir):
    log = tb.damaged(spark, sf_dir)[1]
    return plain(recall.recall_literal(log, _run(spark, sf_dir).exceptions))


def recall_attributed(spark, sf_dir):
    log = tb.damaged(spark, sf_dir)[1]
    return plain(recall.recall_attributed(log, _run(spark, sf_dir).exceptions, _catalog(spark)))


# --- marts --------------------------------------------------------------------------


def mart_rule_scorecard(spark, sf_dir):
    return plain(_scorecard(spark, sf_dir))


def mart_exception_ageing(spark, sf_dir):
    return _ageing(spark, sf_dir)


def mart_daily_control(spark, sf_dir):
    return plain(_daily_control(spark, sf_dir))


def mart_exception_detail(spark, sf_dir):
    wh = tb.warehouse(spark, sf_dir)
    queue = new_exceptions(mark_new(failing(wh, RULES, AS_OF), None), AS_OF)
    return plain(marts.exception_detail(queue, _catalog(spark), wh.fact).drop("exception_id"))


def top_failing_rules(spark, sf_dir):
    return plain(marts.top_failing_rules(_scorecard(spark, sf_dir)))


def top_failing_rules_latest_day(spark, sf_dir):
    scorecard, _ = settle(_daily_scorecard(spark, sf_dir))
    return plain(marts.top_failing_rules(scorecard))


def summary_store(spark, sf_dir):
    """The latest of the summaries that runs have appended to their table."""
    path = scratch_path(spark, "summaries")
    earlier = spark.createDataFrame([(date(2026, 1, 19), "an earlier summary")], SUMMARIES)
    tables.append_table(earlier, path)
    top = marts.top_failing_rules(_scorecard(spark, sf_dir))
    tables.append_table(marts.control_summary(top, REPORT_DATE), path)
    return plain(marts.latest_summary(tables.read_table(spark, path, SUMMARIES)))


def reset_run(spark, sf_dir):
    """A stored queue is emptied; the next run queues all findings again."""
    folder = scratch_path(spark, "store")
    first = _run(spark, sf_dir)
    store_pipeline({"new_exceptions": first.exceptions, "new_run_log": first.log}, folder)
    reset_store(spark, folder)
    queue = tables.read_table(spark, f"{folder}/exceptions", EXCEPTIONS)
    again = run_rules(tb.warehouse(spark, sf_dir), RULES, AS_OF, queue=queue)
    store_pipeline({"new_exceptions": again.exceptions, "new_run_log": again.log}, folder)
    stored = tables.read_table(spark, f"{folder}/exceptions", EXCEPTIONS)
    return plain(stored.groupBy("rule_id").agg(F.count(F.lit(1)).alias("queued")))


def control_summary(spark, sf_dir):
    top = marts.top_failing_rules(_scorecard(spark, sf_dir))
    return plain(marts.control_summary(top, REPORT_DATE))


def _rounded(df: DataFrame, column: str, places: int = 8) -> DataFrame:
    return df.withColumn(column, F.round(column, places))


def kpi_pass_rate(spark, sf_dir):
    return _rounded(marts.pass_rate(_scorecard(spark, sf_dir)), "pass_rate")


def kpi_open_high(spark, sf_dir):
    return marts.open_high(_ageing(spark, sf_dir))


def kpi_sla_met(spark, sf_dir):
    return _rounded(marts.sla_met(_daily_control(spark, sf_dir)), "sla_met_share")


def failures_by_dimension(spark, sf_dir):
    return marts.failures_by_dimension(_scorecard(spark, sf_dir))


def control_trend(spark, sf_dir):
    return plain(marts.control_trend(_daily_control(spark, sf_dir)))


def rule_date_matrix(spark, sf_dir):
    return marts.rule_date_matrix(_daily_scorecard(spark, sf_dir), MATRIX_DAYS)


def dest_lookup(spark, sf_dir):
    return tables.destination_counts(tb.warehouse(spark, sf_dir).fact, *LOOKUP)


def dest_lookup_laid_out(spark, sf_dir):
    path = scratch_path(spark, "laid-out")
    tables.write_lookup_layout(tb.warehouse(spark, sf_dir).fact, path)
    return tables.destination_counts(tables.read_table(spark, path), *LOOKUP)


def fraud_subset(spark, sf_dir):
    return plain(tables.fraud_rows(tb.warehouse(spark, sf_dir).fact).select("txn_id", "amount"))


def open_queue(spark, sf_dir):
    return plain(tables.open_rows(_aged_queue(spark, sf_dir)).select("rule_id", "txn_id"))


# --- anomaly model ------------------------------------------------------------------


def _features(spark, sf_dir):
    return anomaly.features(tb.warehouse(spark, sf_dir).fact)


def anomaly_features(spark, sf_dir):
    rows = _features(spark, sf_dir)
    for name in ("log_amt", "bal_ratio_orig"):  # the others are exact cents
        rows = _rounded(rows, name)
    return plain(anomaly.one_hot_types(rows))


def iforest_nodes(spark, sf_dir):
    return anomaly.train(_features(spark, sf_dir))


def _scores(spark, sf_dir):
    return score_transactions(tb.warehouse(spark, sf_dir))


def anomaly_scores(spark, sf_dir):
    return _scores(spark, sf_dir).select("txn_id", "score", "is_anomaly")


def anomaly_eval(spark, sf_dir):
    return anomaly.evaluate(_scores(spark, sf_dir))


def anomaly_flag_counts(spark, sf_dir):
    return anomaly.flag_counts(_scores(spark, sf_dir))


def scores_given_forest(spark, sf_dir):
    """A forest that SQL can state, walked for every row."""
    scored = anomaly.score(_features(spark, sf_dir), tb.given_forest(spark))
    return _rounded(scored.select("txn_id", "score"), "score")


def _given_scores(spark, sf_dir):
    """A stand-in score with ties, so that selection and metrics have one right answer."""
    rows = tb.warehouse(spark, sf_dir).fact.where("amount IS NOT NULL")
    scored, _ = settle(
        rows.selectExpr(
            "txn_id",
            "CAST(is_fraud AS INT) AS is_fraud",
            "type",
            "CAST(floor(amount / 5000) AS DOUBLE) / 1024 AS score",
        )
    )
    return scored


def eval_given_scores(spark, sf_dir):
    return plain(anomaly.evaluate(_given_scores(spark, sf_dir)))


def flag_given_scores(spark, sf_dir):
    return anomaly.flag(_given_scores(spark, sf_dir)).select("txn_id", "score", "is_anomaly")


def exceptions_with_ml(spark, sf_dir):
    """The queue of a run with the model rule on, on top of the run without it."""
    wh = tb.warehouse(spark, sf_dir)
    queue = new_exceptions(mark_new(failing(wh, RULES, AS_OF), None), AS_OF)
    scored = replace(wh, scores=score_transactions(wh))
    rules = [r for r in set_active(RULES, "ANOMALY_IFOREST") if r.rule_code == "ANOMALY_IFOREST"]
    return plain(run_rules(scored, rules, AS_OF, queue=queue).exceptions)


def _with_given_scores(spark, sf_dir):
    flagged = anomaly.flag(_given_scores(spark, sf_dir)).select("txn_id", "score", "is_anomaly")
    return replace(tb.warehouse(spark, sf_dir), scores=flagged)


def rule_anomaly_given_scores(spark, sf_dir):
    return failing_rule(_with_given_scores(spark, sf_dir), RULES, "ANOMALY_IFOREST", AS_OF)


def exceptions_given_scores(spark, sf_dir):
    """The model rule switched on, on top of a queue of all other findings."""
    wh = _with_given_scores(spark, sf_dir)
    queue = new_exceptions(mark_new(failing(wh, RULES, AS_OF), None), AS_OF)
    rules = [r for r in set_active(RULES, "ANOMALY_IFOREST") if r.rule_code == "ANOMALY_IFOREST"]
    return plain(run_rules(wh, rules, AS_OF, queue=queue).exceptions.drop("exception_id"))


def flag_counts_given_scores(spark, sf_dir):
    counts = anomaly.flag_counts(anomaly.flag(_given_scores(spark, sf_dir)))
    return _rounded(_rounded(counts, "share_pct"), "mean_score")


def by_type_given_scores(spark, sf_dir):
    return _rounded(marts.anomalies_by_type(_overview_given(spark, sf_dir)), "mean_score")


def forest_invariants(spark, sf_dir):
    """What any forest of the published settings has, whatever its draws."""
    leaves = anomaly.train(_features(spark, sf_dir)).where("feature < 0")
    per_tree = leaves.groupBy("tree").agg(F.sum("rows").alias("rows"), F.max("depth").alias("depth"))
    return plain(per_tree.agg(
        F.count(F.lit(1)).alias("trees"), F.min("rows").alias("least_rows"), F.max("rows").alias("most_rows"),
        (F.max("depth") <= anomaly.DEPTH).alias("within_depth"),
    ))


def _overview(spark, sf_dir):
    wh = tb.warehouse(spark, sf_dir)
    return marts.anomaly_overview(wh.fact, score_transactions(wh))


def mart_anomaly_overview(spark, sf_dir):
    return plain(_overview(spark, sf_dir))


def anomaly_top50(spark, sf_dir):
    return plain(marts.top_anomalies(_overview(spark, sf_dir)))


def anomaly_by_type(spark, sf_dir):
    return marts.anomalies_by_type(_overview(spark, sf_dir))


def anomaly_histogram(spark, sf_dir):
    return plain(marts.score_histogram(_overview(spark, sf_dir)))


def _overview_given(spark, sf_dir):
    fact = tb.warehouse(spark, sf_dir).fact
    return marts.anomaly_overview(fact, anomaly.flag(_given_scores(spark, sf_dir)))


def overview_given_scores(spark, sf_dir):
    return plain(_overview_given(spark, sf_dir))


def top50_given_scores(spark, sf_dir):
    top = marts.top_anomalies(_overview_given(spark, sf_dir))
    return plain(top.select("txn_id", "type", "amount", "anomaly_score", "is_anomaly"))


def histogram_given_scores(spark, sf_dir):
    return plain(marts.score_histogram(_overview_given(spark, sf_dir)))


QUERIES: dict[str, Query] = {
    "stage_transactions": stage_transactions,
    "stage_transactions_without_key": stage_transactions_without_key,
    "stage_customer_master": stage_customer_master,
    "stage_settlements": stage_settlements,
    "stage_rejects": stage_rejects,
    "stage_text_feed": stage_text_feed,
    "inject_defects": inject_defects,
    "injected_defects_log": injected_defects_log,
    "inject_defects_other_seed": inject_defects_other_seed,
    "inject_defects_overlapping": inject_defects_overlapping,
    "feed_round_trip": feed_round_trip,
    "defect_counts": defect_counts,
    "dim_customer": dim_customer,
    "dim_txn_type": dim_txn_type,
    "dim_time": dim_time,
    "fact_transactions": fact_transactions,
    "pk_violations": pk_violations,
    "catalog_violations": catalog_violations,
    "account_universe": account_universe,
    "star_join_daily": star_join_daily,
    "rule_catalog": rule_catalog,
    **{
        f"rule_{rule.rule_code.lower()}": _rule(rule.rule_code)
        for rule in RULES
        if rule.rule_code != "ANOMALY_IFOREST"
    },
    "rule_anomaly_iforest": rule_anomaly_iforest,
    "all_exceptions": all_exceptions,
    "exceptions": exceptions,
    "exceptions_incremental": exceptions_incremental,
    "exceptions_by_delta": exceptions_by_delta,
    "stored_queue": stored_queue,
    "stored_open_queue": stored_open_queue,
    "run_log": run_log_query,
    "run_log_second_run": run_log_second_run,
    "exception_lifecycle": exception_lifecycle,
    "custom_sql_rule": custom_sql_rule,
    "forty_user_rules": forty_user_rules,
    "twenty_joined_rules": twenty_joined_rules,
    "settlement_rules_bucketed": settlement_rules_bucketed,
    "catalog_round_trip": catalog_round_trip,
    "recall_literal": recall_literal,
    "recall_attributed": recall_attributed,
    "mart_rule_scorecard": mart_rule_scorecard,
    "mart_exception_ageing": mart_exception_ageing,
    "mart_daily_control": mart_daily_control,
    "mart_exception_detail": mart_exception_detail,
    "mart_anomaly_overview": mart_anomaly_overview,
    "top_failing_rules": top_failing_rules,
    "top_failing_rules_latest_day": top_failing_rules_latest_day,
    "control_summary": control_summary,
    "summary_store": summary_store,
    "reset_run": reset_run,
    "kpi_pass_rate": kpi_pass_rate,
    "kpi_open_high": kpi_open_high,
    "kpi_sla_met": kpi_sla_met,
    "failures_by_dimension": failures_by_dimension,
    "control_trend": control_trend,
    "rule_date_matrix": rule_date_matrix,
    "dest_lookup": dest_lookup,
    "dest_lookup_laid_out": dest_lookup_laid_out,
    "party_lookups": party_lookups,
    "fraud_subset": fraud_subset,
    "open_queue": open_queue,
    "anomaly_features": anomaly_features,
    "iforest_nodes": iforest_nodes,
    "anomaly_scores": anomaly_scores,
    "anomaly_eval": anomaly_eval,
    "anomaly_flag_counts": anomaly_flag_counts,
    "anomaly_top50": anomaly_top50,
    "anomaly_by_type": anomaly_by_type,
    "anomaly_histogram": anomaly_histogram,
    "scores_given_forest": scores_given_forest,
    "eval_given_scores": eval_given_scores,
    "flag_given_scores": flag_given_scores,
    "overview_given_scores": overview_given_scores,
    "top50_given_scores": top50_given_scores,
    "histogram_given_scores": histogram_given_scores,
    "rule_anomaly_given_scores": rule_anomaly_given_scores,
    "exceptions_given_scores": exceptions_given_scores,
    "flag_counts_given_scores": flag_counts_given_scores,
    "by_type_given_scores": by_type_given_scores,
    "forest_invariants": forest_invariants,
    "exceptions_with_ml": exceptions_with_ml,
}
