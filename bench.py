"""Headline timings, as one JSON line.

The warehouse tables are built and written first (timed as `build_warehouse`), and the rest
reads those tables, as a daily run does. Each figure is the median of the warm runs.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from dataclasses import replace

from ledgerwatch.operators import anomaly
from ledgerwatch.operators.catalog import add_rule, standard_rules
from ledgerwatch.operators.queue import mark_new
from ledgerwatch.operators.rules import failing
from ledgerwatch.operators.warehouse import Warehouse
from ledgerwatch.plans import testbed as tb
from ledgerwatch.plans.run import run_rules
from ledgerwatch.session import local_session, settle
from ledgerwatch.sources import tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
LOOKUP = ("C7", 100, 200)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, "bench", **{"spark.sql.shuffle.partitions": CPUS.strip("*") or "8"})
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    rules = standard_rules()
    names = ("fact", "customer_master", "settlements", "dim_customer")

    def build() -> Warehouse:
        lazy = tb.warehouse(spark, SF_DIR)
        return Warehouse(**{name: settle(getattr(lazy, name))[0] for name in names})

    wh = build()
    tables.write_lookup_layout(wh.fact, f"{work}/laid", files=int(CPUS.strip("*") or 8))
    laid = spark.read.parquet(f"{work}/laid")
    rows = anomaly.features(wh.fact)
    count = rows.count()
    forest, _ = settle(anomaly.train(rows, count=count))
    scored, _ = settle(anomaly.score(rows, forest))
    with_scores = replace(wh, scores=anomaly.flag(scored))
    queue, _ = settle(run_rules(wh, rules, tb.AS_OF).exceptions)
    row_rules = [r for r in rules if r.kind == "row"]

    def separately() -> None:
        for rule in row_rules:
            drain(failing(wh, [rule], tb.AS_OF))

    hundred = rules
    for k in range(81):
        hundred = add_rule(hundred, f"USER_{k}", "Validity", "LOW", "x", predicate=f"amount > {k * 9000} AND step % 90 = {k}")
    hundred = [r for r in hundred if r.kind == "row"]

    def of_kind(kind: str):
        chosen = [r for r in rules if r.kind == kind]
        return lambda: drain(failing(wh, chosen, tb.AS_OF))

    def full_run() -> None:
        run = run_rules(wh, rules, tb.AS_OF, written=True)
        drain(run.exceptions)
        run.log.collect()

    jobs = {
        "dest_lookup_plain": lambda: tables.destination_counts(wh.fact, *LOOKUP).collect(),
        "dest_lookup_laid_out": lambda: tables.destination_counts(laid, *LOOKUP).collect(),
        "rule_bal_orig_mismatch": lambda: drain(
            failing(wh, [r for r in rules if r.rule_code == "BAL_ORIG_MISMATCH"], tb.AS_OF)
        ),
        "row_rules_fused": of_kind("row"),
        "row_rules_separate": separately,
        "hundred_rules": lambda: drain(failing(wh, hundred, tb.AS_OF)),
        "account_rules": of_kind("account"),
        "copies_rule": of_kind("copies"),
        "reference_rule": of_kind("reference"),
        "settlement_rules": of_kind("settlement"),
        "outlier_rule": of_kind("outlier"),
        "velocity_rule": of_kind("velocity"),
        "full_rule_run": full_run,
        "second_rule_run": lambda: drain(mark_new(failing(wh, rules, tb.AS_OF), queue)),
        "forest_train": lambda: drain(anomaly.train(rows, count=count)),
        "forest_score": lambda: drain(anomaly.score(rows, forest)),
        "forest_flag_and_evaluate": lambda: anomaly.evaluate(anomaly.flag(scored)).collect(),
        "model_rule": lambda: drain(
            failing(with_scores, [replace(r, active=True) for r in rules if r.kind == "model"], tb.AS_OF)
        ),
        "build_warehouse": build,
    }
    timings = {}
    for name, job in jobs.items():
        job()
        taken = []
        for _ in range(RUNS):
            start = time.perf_counter()
            job()
            taken.append(time.perf_counter() - start)
        timings[name] = round(statistics.median(taken), 4)
    print(
        json.dumps(
            {
                "metric": "full_rule_run",
                "value": timings["full_rule_run"],
                "unit": "sec",
                "queries": timings,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
                "fact_rows": wh.fact.count(),
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
