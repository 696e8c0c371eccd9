"""Declared schemas. Landing tables are all text; everything after is typed."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the three feeds, in order.
TRANSACTION_COLUMNS = (
    ("step", "int"),
    ("type", "string"),
    ("amount", "decimal(18,2)"),
    ("name_orig", "string"),
    ("oldbalance_org", "decimal(18,2)"),
    ("newbalance_orig", "decimal(18,2)"),
    ("name_dest", "string"),
    ("oldbalance_dest", "decimal(18,2)"),
    ("newbalance_dest", "decimal(18,2)"),
    ("is_fraud", "smallint"),
    ("is_flagged_fraud", "smallint"),
)
CUSTOMER_COLUMNS = (
    ("account_id", "string"),
    ("segment", "string"),
    ("kyc_status", "string"),
    ("country", "string"),
    ("opened_date", "date"),
)
SETTLEMENT_COLUMNS = (
    ("settlement_ref", "string"),
    ("txn_id", "bigint"),
    ("settled_amount", "decimal(18,2)"),
    ("settlement_date", "date"),
)

FEEDS = {
    "transactions": TRANSACTION_COLUMNS,
    "customer_master": CUSTOMER_COLUMNS,
    "settlements": SETTLEMENT_COLUMNS,
}


MALFORMED = "_malformed"  # the line as it came, if its fields are too few or too many


def landing_schema(feed: str, keyed: bool = False) -> T.StructType:
    """All-text schema of a feed; `keyed` puts the source's own txn_id in front."""
    names = [name for name, _ in FEEDS[feed]]
    if keyed:
        names.insert(0, "txn_id")
    return T.StructType([T.StructField(name, T.StringType()) for name in [*names, MALFORMED]])


# How text feeds are read, in batch and stream: header names are checked against the schema, and
# a row of the wrong length is kept apart instead of being cut or filled up.
FEED_OPTIONS = {
    "header": True,
    "enforceSchema": False,
    "emptyValue": "",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": MALFORMED,
    "columnPruning": False,
}


EXCEPTIONS = (
    "exception_id bigint, rule_id int, txn_id bigint, detected_at timestamp, status string, "
    "assigned_to string, resolved_at timestamp, note string"
)
RUN_LOG = (
    "run_id bigint, rule_id int, run_ts timestamp, records_checked bigint, "
    "records_failed bigint, records_failing bigint"
)
SCORES = "txn_id bigint, score double, is_anomaly boolean"
SUMMARIES = "run_date date, summary string"
