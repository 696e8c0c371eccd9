from datetime import datetime

from builders import AS_OF
from pyspark.sql import functions as F

from ledgerwatch.operators.catalog import standard_rules
from ledgerwatch.operators.rules import failing
from ledgerwatch.plans import testbed as tb
from ledgerwatch.sources.tables import read_table, write_feed
from ledgerwatch.streaming.landing import landed_transactions, queue_landed

RULES = standard_rules()


def test_landed_files_reach_the_queue_once(spark, sf_dir, tmp_path):
    feed = tb.as_text(tb.damaged(spark, sf_dir)[0])
    landing, queue = str(tmp_path / "landing"), str(tmp_path / "queue")
    row_rules = [r for r in RULES if r.kind == "row"]
    want = failing(tb.warehouse(spark, sf_dir), row_rules, AS_OF)

    def run(state, moment=AS_OF):
        stream = landed_transactions(spark, f"{landing}/*")
        queue_landed(stream, RULES, moment, queue, str(tmp_path / state)).awaitTermination()
        return read_table(spark, queue).select("rule_id", "txn_id")

    write_feed(feed.where("txn_id % 2 = 0"), f"{landing}/one")
    first = run("state")
    assert first.exceptAll(want.where("txn_id % 2 = 0")).isEmpty()
    write_feed(feed.where("txn_id % 2 = 1"), f"{landing}/two")
    both = run("state")
    assert both.exceptAll(want).isEmpty() and want.exceptAll(both).isEmpty()
    # all files once more, as after a lost state: nothing is queued twice
    again = run("other_state", datetime(2026, 1, 20))
    assert again.count() == want.count()
    assert again.groupBy("rule_id", "txn_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
