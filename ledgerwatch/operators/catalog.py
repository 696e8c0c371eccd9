"""The rule catalog: rules are rows, and adding a rule adds a row, not code."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

SEVERITIES = ("HIGH", "MEDIUM", "LOW")

# Rule kinds. ROW rules hold a predicate over one fact row and share one scan, and so do JOINED ones,
# whose predicate also sees the row of a dimension. QUERY rules hold SQL that returns txn_id. The other kinds are built in and named by what they look at.
ROW, JOINED, QUERY = "row", "joined", "query"
SETTLEMENT, ACCOUNT, COPIES, REFERENCE, OUTLIER, VELOCITY, MODEL = (
    "settlement",
    "account",
    "copies",
    "reference",
    "outlier",
    "velocity",
    "model",
)


# The shipped limits of the built-in rules that have some.
PARAMS = {
    "LATE_SETTLEMENT": {"days": 2},
    "AMOUNT_ZSCORE_BY_TYPE": {"deviations": 4},
    "DEST_VELOCITY": {"arrivals": 10, "hours_back": 3},
}


# the dimensions that joined rules may name, each with the key it is unique on
DIMENSION_KEYS = {"dim_customer": "account_id", "dim_time": "time_key", "dim_txn_type": "type"}
JOINED_TEXT = re.compile(r"JOIN (\w+) ON (\w+) WHERE (.+)", re.DOTALL)


@dataclass(frozen=True)
class Rule:
    rule_id: int
    rule_code: str
    dimension: str
    severity: str
    description: str
    kind: str
    rule_sql: str | None = None
    active: bool = True
    params: Mapping[str, float] = field(default_factory=dict)  # limits of a built-in rule

    def __post_init__(self):
        if self.severity not in SEVERITIES:
            raise ValueError(f"{self.rule_code}: severity must be one of {SEVERITIES}")
        if self.kind in (ROW, JOINED, QUERY) and not self.rule_sql:
            raise ValueError(f"{self.rule_code}: a {self.kind} rule needs SQL text")
        if self.kind == JOINED:
            self.joined()
        unknown = set(self.params) - set(PARAMS.get(self.rule_code, ()))
        if unknown:
            raise ValueError(f"{self.rule_code} has no limit {sorted(unknown)}")

    def joined(self) -> tuple[str, str, str]:
        """Table, fact column and predicate of a joined rule."""
        found = JOINED_TEXT.fullmatch(self.rule_sql or "")
        if not found or found[1] not in DIMENSION_KEYS:
            raise ValueError(f"{self.rule_code}: a joined rule reads JOIN <one of {sorted(DIMENSION_KEYS)}> ON <fact column> WHERE <predicate>")
        return found[1], found[2], found[3]

    def limit(self, name: str) -> float:
        """A limit of a built-in rule: the catalog's own, or the shipped one."""
        return self.params.get(name, PARAMS[self.rule_code][name])


# Codes, dimensions, severities, limits and the account pattern of the 30 rules.
# Predicates are three-valued: a NULL operand flags nothing unless the rule asks for NULL.
# `\z` ends the pattern because `$` would let a trailing newline through.
_ROWS = (
    ("NULL_AMOUNT", "Completeness", "HIGH", "No amount", ROW, "amount IS NULL"),
    ("NULL_TYPE", "Completeness", "HIGH", "No transaction type", ROW, "type IS NULL"),
    ("NULL_ORIG_ACCT", "Completeness", "HIGH", "No origin account", ROW, "name_orig IS NULL"),
    ("NULL_DEST_ACCT", "Completeness", "HIGH", "No destination account", ROW, "name_dest IS NULL"),
    (
        "NULL_BALANCE_FIELDS",
        "Completeness",
        "HIGH",
        "One of the four balances is not given",
        ROW,
        "oldbalance_org IS NULL OR newbalance_orig IS NULL"
        " OR oldbalance_dest IS NULL OR newbalance_dest IS NULL",
    ),
    ("NEG_AMOUNT", "Validity", "HIGH", "Amount below zero", ROW, "amount < 0"),
    ("ZERO_AMOUNT", "Validity", "MEDIUM", "Amount of zero", ROW, "amount = 0"),
    (
        "INVALID_TYPE",
        "Validity",
        "HIGH",
        "Type outside the five known ones",
        ROW,
        "type NOT IN ('CASH_IN', 'CASH_OUT', 'DEBIT', 'PAYMENT', 'TRANSFER')",
    ),
    ("AMOUNT_OVER_LIMIT", "Validity", "MEDIUM", "Amount over 10 million", ROW, "amount > 10000000"),
    (
        "BAD_ACCT_FORMAT",
        "Validity",
        "HIGH",
        "Account is not C or M and digits",
        ROW,
        r"NOT name_orig RLIKE r'^[CM][0-9]+\z' OR NOT name_dest RLIKE r'^[CM][0-9]+\z'",
    ),
    ("STEP_OUT_OF_RANGE", "Validity", "HIGH", "Hour outside 0 to 744", ROW, "step < 0 OR step > 744"),
    (
        "BAL_ORIG_MISMATCH",
        "Consistency",
        "HIGH",
        "Origin balance moved by something else than the amount",
        ROW,
        "abs(newbalance_orig - oldbalance_org - IF(type = 'CASH_IN', amount, -amount)) > 0.01",
    ),
    (
        "BAL_DEST_MISMATCH",
        "Consistency",
        "HIGH",
        "Destination balance moved by something else than the amount, merchants aside",
        ROW,
        "NOT startswith(name_dest, 'M') AND"
        " abs(newbalance_dest - oldbalance_dest - IF(type = 'CASH_IN', -amount, amount)) > 0.01",
    ),
    (
        "ORIG_NEG_BALANCE",
        "Consistency",
        "MEDIUM",
        "Origin balance below zero",
        ROW,
        "oldbalance_org < 0 OR newbalance_orig < 0",
    ),
    (
        "DEST_NEG_BALANCE",
        "Consistency",
        "MEDIUM",
        "Destination balance below zero",
        ROW,
        "oldbalance_dest < 0 OR newbalance_dest < 0",
    ),
    (
        "FLAG_RULE_MISMATCH",
        "Consistency",
        "MEDIUM",
        "Transfer over 200,000 without the fraud flag",
        ROW,
        "type = 'TRANSFER' AND amount > 200000 AND is_flagged_fraud = 0",
    ),
    ("SELF_TRANSFER", "Consistency", "MEDIUM", "Both sides are one account", ROW, "name_orig = name_dest"),
    (
        "PAYMENT_DEST_NOT_MERCHANT",
        "Consistency",
        "MEDIUM",
        "Payment to an account that is no merchant",
        ROW,
        "type = 'PAYMENT' AND NOT startswith(name_dest, 'M')",
    ),
    (
        "DUP_BUSINESS_KEY",
        "Uniqueness",
        "MEDIUM",
        "Same parties, amount, hour and type as an earlier transaction",
        COPIES,
        None,
    ),
    (
        "DUP_CUSTOMER_MASTER",
        "Uniqueness",
        "MEDIUM",
        "A party is in the customer master more than once",
        ACCOUNT,
        None,
    ),
    (
        "DUP_SETTLEMENT_REF",
        "Uniqueness",
        "MEDIUM",
        "Settlement reference used before",
        REFERENCE,
        None,
    ),
    ("ORPHAN_ORIG", "Integrity", "HIGH", "Origin customer is unknown", ACCOUNT, None),
    ("ORPHAN_DEST", "Integrity", "HIGH", "Destination customer is unknown", ACCOUNT, None),
    ("SETTLEMENT_MISSING", "Integrity", "HIGH", "Never settled", SETTLEMENT, None),
    ("SETTLEMENT_AMOUNT_DIFF", "Integrity", "HIGH", "Settled at another amount", SETTLEMENT, None),
    ("LATE_SETTLEMENT", "Timeliness", "MEDIUM", "Settled more than two days after", SETTLEMENT, None),
    ("FUTURE_DATED", "Timeliness", "LOW", "Dated after the time of the run", ROW, "txn_ts > :as_of"),
    (
        "AMOUNT_ZSCORE_BY_TYPE",
        "Anomaly",
        "MEDIUM",
        "More than four standard deviations over the mean of its type",
        OUTLIER,
        None,
    ),
    (
        "DEST_VELOCITY",
        "Anomaly",
        "MEDIUM",
        "More than ten transactions into the destination within four hours",
        VELOCITY,
        None,
    ),
    ("ANOMALY_IFOREST", "Anomaly", "MEDIUM", "Flagged by the isolation forest", MODEL, None),
)


def standard_rules() -> list[Rule]:
    """The shipped catalog. The model rule stays off until scores exist."""
    return [
        Rule(number, *row, active=row[0] != "ANOMALY_IFOREST", params=PARAMS.get(row[0], {}))
        for number, row in enumerate(_ROWS, start=1)
    ]


def add_rule(
    rules: Iterable[Rule],
    rule_code: str,
    dimension: str,
    severity: str,
    description: str,
    *,
    predicate: str | None = None,
    query: str | None = None,
    joined: tuple[str, str] | None = None,
) -> list[Rule]:
    """The rules and one more, given as a predicate on a fact row or as a query.

    With `joined` = (dimension, fact column) the predicate also sees the dimension's row whose key is
    the value of that column, as in `dim_customer.kyc_status = 'REJECTED'`; a transaction without such
    a row does not fail. Any number of these rules share the scan of the fact.

    A query names the tables `{fact}`, `{customer_master}`, `{settlements}`,
    `{dim_customer}`, `{dim_time}`, `{dim_txn_type}` and, if there are any, `{scores}` and
    `{injected_defects}`, and returns `txn_id`.
    """
    rules = list(rules)
    if (predicate is None) == (query is None):
        raise ValueError("give either a predicate or a query")
    if any(rule.rule_code == rule_code for rule in rules):
        raise ValueError(f"rule {rule_code} exists")
    number = max((rule.rule_id for rule in rules), default=0) + 1
    kind, text = (ROW, predicate) if query is None else (QUERY, query)
    if joined is not None:
        if predicate is None:
            raise ValueError("a joined rule needs a predicate")
        kind, text = JOINED, f"JOIN {joined[0]} ON {joined[1]} WHERE {predicate}"
    return rules + [Rule(number, rule_code, dimension, severity, description, kind, text)]


CATALOG = (
    "rule_id int, rule_code string, dimension string, severity string, description string, "
    "kind string, rule_sql string, active boolean, params map<string, double>"
)


def set_active(rules: Iterable[Rule], rule_code: str, active: bool = True) -> list[Rule]:
    return [replace(r, active=active) if r.rule_code == rule_code else r for r in rules]


def catalog_frame(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    rows = [
        (
            r.rule_id, r.rule_code, r.dimension, r.severity, r.description, r.kind, r.rule_sql, r.active,
            {name: float(value) for name, value in r.params.items()},
        )
        for r in rules
    ]
    return spark.createDataFrame(rows, CATALOG)


def rules_from_frame(catalog: DataFrame) -> list[Rule]:
    """The rules of a stored catalog, whoever edited it; a catalog is a short table.

    A table without kinds holds predicates and queries only: text that selects is a query. Rules
    that are not set active or inactive are active.
    """
    known = {rule.rule_code: rule for rule in standard_rules()}
    rules = []
    for row in sorted(catalog.collect(), key=lambda r: r["rule_id"]):
        given = row.asDict()
        text = given.get("rule_sql")
        if not (kind := given.get("kind")):
            query = text is not None and text.strip().lower().startswith(("select", "with"))
            joined = text is not None and JOINED_TEXT.fullmatch(text)
            kind = QUERY if query else JOINED if joined else ROW if text else known[given["rule_code"]].kind
        rules.append(Rule(
            given["rule_id"], given["rule_code"], given["dimension"], given["severity"],
            given.get("description") or "", kind, text, given.get("active") is not False,
            {name: value for name, value in (given.get("params") or {}).items() if value is not None},
        ))
    for what in ("rule_id", "rule_code"):
        if len({getattr(rule, what) for rule in rules}) < len(rules):
            raise ValueError(f"the catalog repeats a {what}")
    return rules
