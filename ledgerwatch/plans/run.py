"""A rule run, and the pipeline from raw feeds to marts."""

from __future__ import annotations

import os
import warnings
from collections.abc import Iterable
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.lookups import Limits
from ledgerwatch.operators import anomaly
from ledgerwatch.operators.catalog import MODEL, Rule, catalog_frame, standard_rules
from ledgerwatch.operators.queue import mark_new, new_exceptions, run_log, utc
from ledgerwatch.operators.rules import failing_pairs
from ledgerwatch.operators.staging import stage, stage_transactions
from ledgerwatch.operators.warehouse import Warehouse, build_warehouse, require_key
from ledgerwatch.plans import marts
from ledgerwatch.session import settle
from ledgerwatch.sources.schemas import EXCEPTIONS, RUN_LOG, SUMMARIES
from ledgerwatch.sources.tables import append_table, replace_table


@dataclass(frozen=True)
class RuleRun:
    exceptions: DataFrame  # new queue rows
    log: DataFrame


def run_rules(
    wh: Warehouse,
    rules: Iterable[Rule],
    as_of: datetime,
    run_ts: datetime | None = None,
    queue: DataFrame | None = None,
    limits: Limits = Limits(),
    written: bool = False,
) -> RuleRun:
    """Run the active rules and queue what is not queued yet.

    `written` writes the failing pairs out once; use it when both results are read.
    """
    rules, run_ts = list(rules), run_ts or as_of
    marked = mark_new(failing_pairs(wh, rules, as_of, limits), queue)
    if written:
        marked, _ = settle(marked)
    return RuleRun(new_exceptions(marked, run_ts), run_log(marked, wh.fact, rules, run_ts))


def score_transactions(wh: Warehouse, trees: int = anomaly.TREES, seed: int = anomaly.SEED):
    """(txn_id, is_fraud, type, score, is_anomaly): train, score into a written table, flag.

    Without a row that has an amount there is nothing to train on, and no row is scored.
    """
    rows = anomaly.features(wh.fact)
    count = rows.count()
    if not count:
        return anomaly.flag(rows.select("txn_id", "is_fraud", "type", F.lit(0.0).alias("score")))
    forest, _ = settle(anomaly.train(rows, trees, seed=seed, count=count))
    scored, _ = settle(anomaly.score(rows, forest))
    return anomaly.flag(scored)


def run_pipeline(
    raw_transactions: DataFrame,
    raw_customer_master: DataFrame,
    raw_settlements: DataFrame,
    as_of: datetime,
    rules: Iterable[Rule] | None = None,
    queue: DataFrame | None = None,
    history: DataFrame | None = None,
    reset: bool = False,
    limits: Limits = Limits(),
    with_model: bool = True,
    with_summary: bool = True,
) -> dict[str, DataFrame]:
    """Feeds to marts. Earlier exceptions and log rows are kept unless `reset`.

    The warehouse tables are written once and read by everything after. A model that fails is
    reported as a warning and the rules run without it; a model rule that is in the catalog but
    switched off by the caller stays off. `store_pipeline` keeps the results.
    """
    spark = raw_transactions.sparkSession
    if reset:
        queue = history = None
    fact_wh = build_warehouse(
        stage_transactions(raw_transactions),
        stage(raw_customer_master, "customer_master"),
        stage(raw_settlements, "settlements"),
    )
    tables = {
        name: settle(getattr(fact_wh, name))[0]
        for name in ("fact", "customer_master", "settlements", "dim_customer")
    }
    wh = Warehouse(**tables)
    require_key(wh.fact, "txn_id", "fact_transactions")
    require_key(wh.dim_customer, "account_id", "dim_customer")

    shipped = rules is None
    rules = standard_rules() if shipped else list(rules)
    # the shipped catalog has the model rule off until there are scores
    wanted = shipped or any(rule.kind == MODEL and rule.active for rule in rules)
    if with_model and wanted and not wh.fact.isEmpty():
        try:
            scores = score_transactions(wh)
            wh = replace(wh, scores=scores.select("txn_id", "score", "is_anomaly"))
        except Exception as error:  # the other rules do not need it
            warnings.warn(f"the anomaly model failed, its rule is left out: {error}", stacklevel=2)
    rules = [
        replace(rule, active=wh.scores is not None and (shipped or rule.active)) if rule.kind == MODEL else rule
        for rule in rules
    ]

    run = run_rules(wh, rules, as_of, queue=queue, limits=limits, written=True)
    catalog = catalog_frame(spark, rules)
    exceptions = run.exceptions if queue is None else queue.unionByName(run.exceptions)
    log = run.log if history is None else history.unionByName(run.log)
    scorecard = marts.rule_scorecard(log, catalog)
    result = {
        **tables,
        "rule_catalog": catalog,
        "exceptions": exceptions,
        "new_exceptions": run.exceptions,
        "rule_run_log": log,
        "new_run_log": run.log,
        "rule_scorecard": scorecard,
        "exception_ageing": marts.exception_ageing(exceptions, catalog, as_of),
        "daily_control": marts.daily_control(log, catalog),
        "exception_detail": marts.exception_detail(exceptions, catalog, wh.fact),
    }
    if with_summary:
        result["summary"] = marts.control_summary(marts.top_failing_rules(scorecard), utc(as_of).date())
    if wh.scores is not None:
        result["scores"] = wh.scores
        result["anomaly_overview"] = marts.anomaly_overview(wh.fact, wh.scores)
    return result


# what a run leaves behind, and how it is written
APPENDED = {"new_exceptions": "exceptions", "new_run_log": "rule_run_log", "summary": "summaries"}
REPLACED = ("rule_catalog", "scores")


def store_pipeline(result: dict[str, DataFrame], folder: str) -> None:
    """Append the run's new exceptions, log rows and summary to their tables; replace catalog and scores."""
    for name, table in APPENDED.items():
        if name in result:
            append_table(result[name], os.path.join(folder, table))
    for name in REPLACED:
        if name in result:
            replace_table(result[name], os.path.join(folder, name))


def reset_store(spark, folder: str) -> None:
    """Empty queue, log and summaries, keeping their columns."""
    for table, columns in (("exceptions", EXCEPTIONS), ("rule_run_log", RUN_LOG), ("summaries", SUMMARIES)):
        replace_table(spark.createDataFrame([], columns), os.path.join(folder, table))
