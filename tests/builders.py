"""Small bank tables that the tests build by hand."""

from datetime import datetime

from ledgerwatch.functions.expressions import event_time
from ledgerwatch.operators.warehouse import Warehouse, dim_customer

AS_OF = datetime(2026, 1, 20)
STAGED = (
    "txn_id bigint, step int, type string, amount decimal(18,2), name_orig string, "
    "oldbalance_org decimal(18,2), newbalance_orig decimal(18,2), name_dest string, "
    "oldbalance_dest decimal(18,2), newbalance_dest decimal(18,2), is_fraud smallint, "
    "is_flagged_fraud smallint"
)
MASTER = "account_id string, segment string, kyc_status string, country string, opened_date date"
SETTLED = "settlement_ref string, txn_id bigint, settled_amount decimal(18,2), settlement_date date"


def staged_frame(spark, rows):
    """Rows given as (txn_id, step, type, amount, orig, old, new, dest, old, new[, fraud, flag])."""
    full = [tuple(row) + (0, 0)[: 12 - len(row)] for row in rows]
    text = [tuple(None if v is None else str(v) for v in row) for row in full]
    names = [part.split()[0] for part in STAGED.split(", ")]
    frame = spark.createDataFrame(text, ", ".join(f"{n} string" for n in names))
    return frame.selectExpr(*[
        f"CAST({part.split()[0]} AS {part.split()[1]}) AS {part.split()[0]}"
        for part in STAGED.split(", ")
    ])


def make_warehouse(spark, rows, master=(), settled=()):
    staged = staged_frame(spark, rows)
    fact = staged.withColumn("txn_ts", event_time())
    customers = spark.createDataFrame(list(master), MASTER)
    settlements = spark.createDataFrame(
        [(ref, txn, None if amount is None else str(amount), day) for ref, txn, amount, day in settled],
        SETTLED.replace("decimal(18,2)", "string"),
    ).selectExpr(
        "settlement_ref",
        "txn_id",
        "CAST(settled_amount AS DECIMAL(18,2)) AS settled_amount",
        "settlement_date",
    )
    return Warehouse(fact, customers, settlements, dim_customer(customers))
