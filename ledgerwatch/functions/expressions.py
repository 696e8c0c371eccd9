"""Column expressions of the transaction model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"

# The event-time origin and the five transaction types with their direction.
TIME_ORIGIN = "2026-01-01"
DIRECTIONS = (
    ("CASH_IN", "CREDIT"),
    ("CASH_OUT", "DEBIT"),
    ("DEBIT", "DEBIT"),
    ("PAYMENT", "DEBIT"),
    ("TRANSFER", "DEBIT"),
)


def typed(name: str, sql_type: str, tolerant: bool = False) -> Column:
    """A text column as a typed one: empty text is NULL, bad text fails (or is NULL if tolerant)."""
    text = F.nullif(F.col(name), F.lit(""))
    return (text.try_cast(sql_type) if tolerant else text.cast(sql_type)).alias(name)


def event_time(step: str = "step") -> Column:
    """Hour number to timestamp without zone."""
    return F.expr(f"TIMESTAMP_NTZ '{TIME_ORIGIN}' + `{step}` * INTERVAL '1' HOUR")
