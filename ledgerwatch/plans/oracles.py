"""Each query once more as plain SQL, written from the rules' meaning and not from the Spark plans."""

from __future__ import annotations

# The bank tables over the test tables (see FIXTURES.md).
TABLES = """
base AS (
  SELECT CAST(o_orderkey + 1 AS BIGINT) AS txn_id, o_orderkey AS k, o_custkey AS ck,
         CAST(CASE WHEN o_orderkey % 7 = 5 THEN 100 + o_orderkey % 4
                   ELSE o_orderkey * 7919 % 744 END AS INT) AS step,
         CASE o_orderkey % 5 WHEN 0 THEN 'CASH_IN' WHEN 1 THEN 'CASH_OUT' WHEN 2 THEN 'DEBIT'
                             WHEN 3 THEN 'PAYMENT' ELSE 'TRANSFER' END AS type,
         CAST(CASE WHEN o_orderkey % 499 = 11 THEN o_totalprice * 40
                   ELSE o_totalprice END AS DECIMAL(18,2)) AS amount
  FROM orders),
clean AS (
  SELECT txn_id, step, type, amount, concat('C', ck) AS name_orig,
         CAST(amount + k % 1000 AS DECIMAL(18,2)) AS oldbalance_org,
         CAST(CASE WHEN type = 'CASH_IN' THEN amount + k % 1000 + amount
                   ELSE k % 1000 END AS DECIMAL(18,2)) AS newbalance_orig,
         CASE WHEN type = 'PAYMENT' AND k % 401 <> 3 THEN concat('M', k % 3)
              WHEN k % 307 = 1 THEN concat('C', ck)
              ELSE concat('C', (ck * 31 + k) % (SELECT count(*) FROM customer)) END AS name_dest,
         CAST(amount + k % 500 AS DECIMAL(18,2)) AS oldbalance_dest,
         CAST(CASE WHEN type = 'CASH_IN' THEN k % 500
                   ELSE amount + k % 500 + amount END AS DECIMAL(18,2)) AS newbalance_dest,
         CAST(CASE WHEN k % 499 = 11 THEN 1 ELSE 0 END AS INT) AS is_fraud,
         CAST(CASE WHEN type = 'TRANSFER' AND amount > 200000 AND k % 3 = 0 THEN 1
                   ELSE 0 END AS INT) AS is_flagged_fraud
  FROM base),
picked AS (SELECT *, CAST(txn_id * 48271 % 2147483647 % 1000 AS INT) AS b FROM clean),
stg_transactions AS (
  SELECT txn_id, CASE WHEN b = 11 THEN -1 ELSE step END AS step,
         CASE WHEN b = 8 THEN 'WIRE' WHEN b = 20 THEN NULL ELSE type END AS type,
         CASE WHEN b IN (0, 1) THEN NULL WHEN b IN (2, 3) THEN CAST(-amount AS DECIMAL(18,2))
              WHEN b = 12 THEN CAST(0 AS DECIMAL(18,2)) ELSE amount END AS amount,
         CASE WHEN b = 6 THEN concat('INVALID_', txn_id) WHEN b = 21 THEN NULL
              ELSE name_orig END AS name_orig,
         CASE WHEN b = 24 THEN CAST(-5 AS DECIMAL(18,2)) ELSE oldbalance_org END AS oldbalance_org,
         CASE WHEN b IN (9, 10) THEN CAST(newbalance_orig * 1.5 AS DECIMAL(18,2))
              ELSE newbalance_orig END AS newbalance_orig,
         CASE WHEN b = 22 THEN NULL ELSE name_dest END AS name_dest,
         CASE WHEN b = 25 THEN CAST(-7 AS DECIMAL(18,2)) ELSE oldbalance_dest END AS oldbalance_dest,
         CASE WHEN b = 23 THEN NULL ELSE newbalance_dest END AS newbalance_dest,
         is_fraud, is_flagged_fraud
  FROM picked
  UNION ALL
  SELECT txn_id + 1000000000000000, step, type, amount, name_orig, oldbalance_org, newbalance_orig,
         name_dest, oldbalance_dest, newbalance_dest, is_fraud, is_flagged_fraud
  FROM picked WHERE b IN (4, 5)),
injected_defects AS (
  SELECT CASE WHEN b IN (4, 5) THEN txn_id + 1000000000000000 ELSE txn_id END AS txn_id,
         CASE WHEN b IN (0, 1) THEN 'NULL_AMOUNT' WHEN b IN (2, 3) THEN 'NEG_AMOUNT'
              WHEN b IN (4, 5) THEN 'DUP_TXN' WHEN b = 6 THEN 'BAD_ACCT_FORMAT'
              WHEN b = 8 THEN 'INVALID_TYPE' WHEN b IN (9, 10) THEN 'BAL_TAMPERING'
              WHEN b = 11 THEN 'STEP_OUT_OF_RANGE' ELSE 'ZERO_AMOUNT' END AS defect_type
  FROM picked WHERE b IN (0, 1, 2, 3, 4, 5, 6, 8, 9, 10, 11, 12)),
people AS (
  SELECT c_custkey AS n, concat('C', c_custkey) AS account_id, c_mktsegment AS segment,
         CASE c_custkey % 4 WHEN 0 THEN 'VERIFIED' WHEN 1 THEN 'PENDING' WHEN 2 THEN 'EXPIRED'
                            ELSE 'REJECTED' END AS kyc_status,
         n_name AS country,
         CAST(DATE '2020-01-01' + CAST(c_custkey % 1825 AS INT) AS DATE) AS opened_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
customer_master AS (
  SELECT * EXCLUDE (n) FROM people WHERE n % 199 <> 7
  UNION ALL
  SELECT * EXCLUDE (n) FROM people WHERE n % 211 = 3),
settlements AS (
  SELECT concat('SET', lpad(CAST(CASE WHEN txn_id % 307 = 5 THEN txn_id - 1 ELSE txn_id END
                                 AS VARCHAR), 10, '0')) AS settlement_ref,
         txn_id,
         CASE WHEN txn_id % 199 = 3 THEN CAST(amount + 1 AS DECIMAL(18,2))
              ELSE amount END AS settled_amount,
         CAST(DATE '2026-01-01' + CAST(floor(step / 24) AS INT)
              + CASE WHEN txn_id % 103 = 9 THEN 3 + CAST(txn_id % 5 AS INT) ELSE 1 END
              AS DATE) AS settlement_date
  FROM clean WHERE txn_id % 101 <> 1),
dim_customer AS (SELECT DISTINCT ON (account_id) * FROM customer_master ORDER BY ALL),
fact AS (
  SELECT *, TIMESTAMP '2026-01-01' + step * INTERVAL '1' HOUR AS txn_ts FROM stg_transactions),
catalog(rule_id, rule_code, dimension, severity) AS (VALUES
  (1, 'NULL_AMOUNT', 'Completeness', 'HIGH'),
  (2, 'NULL_TYPE', 'Completeness', 'HIGH'),
  (3, 'NULL_ORIG_ACCT', 'Completeness', 'HIGH'),
  (4, 'NULL_DEST_ACCT', 'Completeness', 'HIGH'),
  (5, 'NULL_BALANCE_FIELDS', 'Completeness', 'HIGH'),
  (6, 'NEG_AMOUNT', 'Validity', 'HIGH'),
  (7, 'ZERO_AMOUNT', 'Validity', 'MEDIUM'),
  (8, 'INVALID_TYPE', 'Validity', 'HIGH'),
  (9, 'AMOUNT_OVER_LIMIT', 'Validity', 'MEDIUM'),
  (10, 'BAD_ACCT_FORMAT', 'Validity', 'HIGH'),
  (11, 'STEP_OUT_OF_RANGE', 'Validity', 'HIGH'),
  (12, 'BAL_ORIG_MISMATCH', 'Consistency', 'HIGH'),
  (13, 'BAL_DEST_MISMATCH', 'Consistency', 'HIGH'),
  (14, 'ORIG_NEG_BALANCE', 'Consistency', 'MEDIUM'),
  (15, 'DEST_NEG_BALANCE', 'Consistency', 'MEDIUM'),
  (16, 'FLAG_RULE_MISMATCH', 'Consistency', 'MEDIUM'),
  (17, 'SELF_TRANSFER', 'Consistency', 'MEDIUM'),
  (18, 'PAYMENT_DEST_NOT_MERCHANT', 'Consistency', 'MEDIUM'),
  (19, 'DUP_BUSINESS_KEY', 'Uniqueness', 'MEDIUM'),
  (20, 'DUP_CUSTOMER_MASTER', 'Uniqueness', 'MEDIUM'),
  (21, 'DUP_SETTLEMENT_REF', 'Uniqueness', 'MEDIUM'),
  (22, 'ORPHAN_ORIG', 'Integrity', 'HIGH'),
  (23, 'ORPHAN_DEST', 'Integrity', 'HIGH'),
  (24, 'SETTLEMENT_MISSING', 'Integrity', 'HIGH'),
  (25, 'SETTLEMENT_AMOUNT_DIFF', 'Integrity', 'HIGH'),
  (26, 'LATE_SETTLEMENT', 'Timeliness', 'MEDIUM'),
  (27, 'FUTURE_DATED', 'Timeliness', 'LOW'),
  (28, 'AMOUNT_ZSCORE_BY_TYPE', 'Anomaly', 'MEDIUM'),
  (29, 'DEST_VELOCITY', 'Anomaly', 'MEDIUM'),
  (30, 'ANOMALY_IFOREST', 'Anomaly', 'MEDIUM'))
"""

_EXPECTED_ORIG = "CASE WHEN type = 'CASH_IN' THEN oldbalance_org + amount ELSE oldbalance_org - amount END"
_EXPECTED_DEST = (
    "CASE WHEN type = 'CASH_IN' THEN oldbalance_dest - amount ELSE oldbalance_dest + amount END"
)
_TWICE = "(SELECT account_id FROM customer_master GROUP BY account_id HAVING count(*) > 1)"


def _over_deviations(times: int) -> str:
    """Amounts over mean + times * deviation, squared out in whole cents so that nothing is rounded."""
    return (
        "SELECT txn_id FROM (SELECT txn_id, type, CAST(amount * 100 AS HUGEINT) AS c FROM fact) JOIN ("
        "SELECT type, count(c) AS n, CAST(sum(c) AS HUGEINT) AS s, CAST(sum(c * c) AS HUGEINT) AS ss"
        " FROM (SELECT type, CAST(amount * 100 AS HUGEINT) AS c FROM fact) GROUP BY type) m"
        " USING (type) WHERE n > 1 AND c * n > s"
        f" AND (c * n - s) * (c * n - s) * (n - 1) > {times * times} * n * (n * ss - s * s)"
    )


RULES = {
    "NULL_AMOUNT": "SELECT txn_id FROM fact WHERE amount IS NULL",
    "NULL_TYPE": "SELECT txn_id FROM fact WHERE type IS NULL",
    "NULL_ORIG_ACCT": "SELECT txn_id FROM fact WHERE name_orig IS NULL",
    "NULL_DEST_ACCT": "SELECT txn_id FROM fact WHERE name_dest IS NULL",
    "NULL_BALANCE_FIELDS": "SELECT txn_id FROM fact WHERE"
    " oldbalance_org + newbalance_orig + oldbalance_dest + newbalance_dest IS NULL",
    "NEG_AMOUNT": "SELECT txn_id FROM fact WHERE amount < 0",
    "ZERO_AMOUNT": "SELECT txn_id FROM fact WHERE amount = 0",
    "INVALID_TYPE": "SELECT txn_id FROM fact WHERE type IS NOT NULL AND NOT EXISTS ("
    " SELECT 1 FROM (VALUES ('CASH_IN'), ('CASH_OUT'), ('DEBIT'), ('PAYMENT'), ('TRANSFER'))"
    " AS known(name) WHERE known.name = fact.type)",
    "AMOUNT_OVER_LIMIT": "SELECT txn_id FROM fact WHERE amount > 10000000",
    "BAD_ACCT_FORMAT": "SELECT txn_id FROM fact WHERE"
    " NOT regexp_full_match(name_orig, '[CM][0-9]+') OR NOT regexp_full_match(name_dest, '[CM][0-9]+')",
    "STEP_OUT_OF_RANGE": "SELECT txn_id FROM fact WHERE step NOT BETWEEN 0 AND 744",
    "BAL_ORIG_MISMATCH": "SELECT txn_id FROM fact WHERE amount IS NOT NULL"
    f" AND newbalance_orig - ({_EXPECTED_ORIG}) NOT BETWEEN -0.01 AND 0.01",
    "BAL_DEST_MISMATCH": "SELECT txn_id FROM fact WHERE amount IS NOT NULL AND name_dest NOT LIKE 'M%'"
    f" AND newbalance_dest - ({_EXPECTED_DEST}) NOT BETWEEN -0.01 AND 0.01",
    "ORIG_NEG_BALANCE": "SELECT txn_id FROM fact WHERE least(oldbalance_org, newbalance_orig) < 0",
    "DEST_NEG_BALANCE": "SELECT txn_id FROM fact WHERE least(oldbalance_dest, newbalance_dest) < 0",
    "FLAG_RULE_MISMATCH": "SELECT txn_id FROM fact"
    " WHERE type = 'TRANSFER' AND amount > 200000 AND is_flagged_fraud = 0",
    "SELF_TRANSFER": "SELECT txn_id FROM fact WHERE name_orig = name_dest",
    "PAYMENT_DEST_NOT_MERCHANT": "SELECT txn_id FROM fact"
    " WHERE type = 'PAYMENT' AND name_dest NOT LIKE 'M%'",
    "DUP_BUSINESS_KEY": "SELECT txn_id FROM fact QUALIFY row_number() OVER"
    " (PARTITION BY name_orig, name_dest, amount, step, type ORDER BY txn_id) > 1",
    "DUP_CUSTOMER_MASTER": f"SELECT txn_id FROM fact WHERE name_orig IN {_TWICE} OR name_dest IN {_TWICE}",
    "DUP_SETTLEMENT_REF": "SELECT txn_id FROM settlements QUALIFY row_number() OVER"
    " (PARTITION BY settlement_ref ORDER BY txn_id NULLS LAST) > 1",
    "ORPHAN_ORIG": "SELECT txn_id FROM fact WHERE name_orig LIKE 'C%'"
    " AND NOT EXISTS (SELECT 1 FROM dim_customer d WHERE d.account_id = fact.name_orig)",
    "ORPHAN_DEST": "SELECT txn_id FROM fact WHERE name_dest LIKE 'C%'"
    " AND NOT EXISTS (SELECT 1 FROM dim_customer d WHERE d.account_id = fact.name_dest)",
    "SETTLEMENT_MISSING": "SELECT txn_id FROM fact"
    " WHERE NOT EXISTS (SELECT 1 FROM settlements s WHERE s.txn_id = fact.txn_id)",
    "SETTLEMENT_AMOUNT_DIFF": "SELECT f.txn_id FROM fact f JOIN settlements s USING (txn_id)"
    " WHERE f.amount <> s.settled_amount",
    "LATE_SETTLEMENT": "SELECT f.txn_id FROM fact f JOIN settlements s USING (txn_id)"
    " WHERE s.settlement_date - CAST(f.txn_ts AS DATE) > 2",
    "FUTURE_DATED": "SELECT txn_id FROM fact WHERE txn_ts > TIMESTAMP '2026-01-20'",
    "AMOUNT_ZSCORE_BY_TYPE": _over_deviations(4),
    "DEST_VELOCITY": "SELECT txn_id FROM fact QUALIFY count(*) OVER"
    " (PARTITION BY name_dest ORDER BY step RANGE BETWEEN 3 PRECEDING AND CURRENT ROW) > 10",
}

_HITS = ",\nhits AS (\n" + "\nUNION ALL\n".join(
    f"SELECT DISTINCT '{code}' AS rule_code, txn_id FROM ({sql})" for code, sql in RULES.items()
) + """),
queue AS (SELECT rule_id, rule_code, dimension, severity, txn_id FROM hits JOIN catalog USING (rule_code)),
run AS (
  SELECT rule_id, rule_code, dimension, severity, (SELECT count(*) FROM fact) AS checked,
         (SELECT count(*) FROM hits h WHERE h.rule_code = c.rule_code) AS failed
  FROM catalog c WHERE rule_code <> 'ANOMALY_IFOREST'),
days AS (SELECT CAST(txn_ts AS DATE) AS day, count(*) AS checked FROM fact GROUP BY ALL),
day_hits AS (
  SELECT rule_code, CAST(txn_ts AS DATE) AS day, count(*) AS failed
  FROM hits JOIN fact USING (txn_id) GROUP BY ALL),
day_run AS (
  SELECT rule_code, dimension, severity, days.day AS day, checked, coalesce(failed, 0) AS failed
  FROM (SELECT * FROM catalog WHERE rule_code <> 'ANOMALY_IFOREST') c CROSS JOIN days
  LEFT JOIN day_hits USING (rule_code, day)),
control AS (
  SELECT day, dimension, severity, sum(failed) AS failed, avg(100.0 * (1 - failed / checked)) AS rate,
         bool_and(100 * failed <= checked) AS sla_met
  FROM day_run GROUP BY ALL),
aged AS (
  SELECT severity, rule_id, txn_id, txn_id % 10 AS age_days,
         CASE WHEN txn_id % 4 = 0 THEN 'RESOLVED' ELSE 'OPEN' END AS status FROM queue),
ageing AS (
  SELECT severity, CASE WHEN age_days < 1 THEN '0-1d' WHEN age_days < 7 THEN '1-7d' ELSE '7d+' END
         AS age_bucket, count(*) AS open_exceptions
  FROM aged WHERE status = 'OPEN' GROUP BY ALL)"""

_GIVEN = """,
given AS (
  SELECT txn_id, is_fraud, type, floor(amount / 5000) / 1024 AS score
  FROM fact WHERE amount IS NOT NULL),
cut AS (SELECT quantile_cont(score, 0.995) AS top_cut FROM given),
flagged AS (SELECT txn_id, score, score > (SELECT top_cut FROM cut) AS is_anomaly FROM given)"""


_GIVEN_FOREST = """
rows AS (
  SELECT txn_id, type, ln(1 + CAST(paid AS DOUBLE)) AS v0, CAST(old_o - new_o - paid AS DOUBLE) AS v1,
         CAST(new_d - old_d - paid AS DOUBLE) AS v2, CAST(old_o AS DOUBLE) AS v3, CAST(old_d AS DOUBLE) AS v4,
         CASE WHEN old_o > 0 THEN least(10, greatest(-10, CAST(paid AS DOUBLE) / CAST(old_o AS DOUBLE))) ELSE 0 END AS v5
  FROM (SELECT txn_id, coalesce(type, '0') AS type, greatest(amount, 0) AS paid,
               coalesce(oldbalance_org, 0) AS old_o, coalesce(newbalance_orig, 0) AS new_o,
               coalesce(oldbalance_dest, 0) AS old_d, coalesce(newbalance_dest, 0) AS new_d
        FROM fact WHERE amount IS NOT NULL)),
nodes AS (
  SELECT tree, node, node >= 15 OR (node >= 3 AND (tree + node) % 5 = 0) AS leaf, (tree * 7 + node * 3) % 7 AS f,
         floor(log2(node + 1)) + (tree * 3 + node) % 16 / 8 AS path,
         CASE (tree + node) % 5 WHEN 0 THEN 'CASH_IN' WHEN 1 THEN 'CASH_OUT' WHEN 2 THEN 'DEBIT'
                                WHEN 3 THEN 'PAYMENT' ELSE 'TRANSFER' END AS category
  FROM (SELECT unnest(range(8)) AS tree) CROSS JOIN (SELECT unnest(range(31)) AS node)),
way AS (
  SELECT r.*, tree, node, leaf, f, path, category FROM rows r CROSS JOIN nodes WHERE node = 0
  UNION ALL
  SELECT w.* EXCLUDE (node, leaf, f, path, category), n.node, n.leaf, n.f, n.path, n.category
  FROM way w JOIN nodes n ON n.tree = w.tree AND NOT w.leaf AND n.node = 2 * w.node + 1 + CAST(CASE w.f
    WHEN 0 THEN v0 > 8 + (w.tree * 5 + w.node) % 5
    WHEN 1 THEN v1 > ((w.tree * 31 + w.node * 17) % 2001 - 1000) * 100
    WHEN 2 THEN v2 > ((w.tree * 31 + w.node * 17) % 2001 - 1000) * 100
    WHEN 3 THEN v3 > (w.tree + w.node * 13) % 50 * 10000
    WHEN 4 THEN v4 > (w.tree + w.node * 13) % 50 * 10000
    WHEN 5 THEN v5 > (w.tree + w.node) % 20 / 16
    ELSE w.type = w.category END AS INT))"""


def _base(select: str) -> str:
    return f"WITH {TABLES}\n{select}"


def _run(select: str) -> str:
    return f"WITH {TABLES}{_HITS}\n{select}"


def _given(select: str) -> str:
    return f"WITH {TABLES}{_GIVEN}\n{select}"


_MONEY = ("amount", "oldbalance_org", "newbalance_orig", "oldbalance_dest", "newbalance_dest")
_STAGED = (
    "CAST(step AS BIGINT) AS step, type, name_orig, name_dest, "
    + ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in _MONEY)
    + ", CAST(is_fraud AS BIGINT) AS is_fraud, CAST(is_flagged_fraud AS BIGINT) AS is_flagged_fraud"
)
_CUSTOMER = "account_id, segment, kyc_status, country, CAST(opened_date AS VARCHAR) AS opened_date"
# the order of the row ids: md5 of the row as text, then the row
_ROW_COLUMNS = (
    "step, type, amount, name_orig, oldbalance_org, newbalance_orig, name_dest, oldbalance_dest, "
    "newbalance_dest, is_fraud, is_flagged_fraud"
)
_ROW_TEXT = " || '|' || ".join(
    f"coalesce(CAST({c} AS VARCHAR), '~')" for c in _ROW_COLUMNS.split(", ")
)
_ROW_ORDER = ", ".join(f"{c} NULLS FIRST" for c in _ROW_COLUMNS.split(", "))
_MATRIX_DAYS = ("2025-12-31", *(f"2026-01-{d:02d}" for d in range(1, 32)))
_FEATURE_TYPES = ("0", "CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER", "WIRE")
_TOP = """top AS (
  SELECT rule_code, dimension, severity, failed, round(100.0 * (1 - failed / checked), 3) AS rate
  FROM run ORDER BY failed DESC, rule_code LIMIT 10)"""


def _draw(row_id: str, seed: int) -> str:
    return f"(({row_id} % 2147483647 + {seed * 16807}) * 1583458089 % 2147483647)"


# the published rates as upper bounds of a draw below 2^31 - 1, in thousandths
_OTHER_SEED = " ".join(
    f"WHEN x < {upto} * 2147483.647 THEN '{defect}'"
    for defect, upto in (
        ("NULL_AMOUNT", 2), ("NEG_AMOUNT", 4), ("DUP_TXN", 6), ("BAD_ACCT_FORMAT", 7),
        ("INVALID_TYPE", 8), ("BAL_TAMPERING", 10), ("STEP_OUT_OF_RANGE", 11), ("ZERO_AMOUNT", 12),
    )
)

ORACLES: dict[str, str] = {
    "stage_transactions": _base(f"SELECT txn_id, {_STAGED} FROM stg_transactions"),
    "stage_transactions_without_key": _base(
        f"SELECT row_number() OVER (ORDER BY md5({_ROW_TEXT}), {_ROW_ORDER}) AS txn_id, {_STAGED}"
        " FROM stg_transactions"
    ),
    "stage_customer_master": _base(f"SELECT {_CUSTOMER} FROM customer_master"),
    "stage_settlements": _base(
        "SELECT settlement_ref, txn_id, CAST(settled_amount AS DOUBLE) AS settled_amount,"
        " CAST(settlement_date AS VARCHAR) AS settlement_date FROM settlements"
    ),
    "stage_rejects": _base(
        "SELECT 'staged' AS outcome, count(*) AS rows,"
        " CAST(sum(settled_amount) AS DOUBLE) AS settled_total FROM settlements WHERE txn_id % 50 <> 0"
        " UNION ALL SELECT 'rejected', count(*), NULL FROM settlements WHERE txn_id % 50 = 0"
    ),
    "stage_text_feed": _base(
        "SELECT 'staged' AS outcome, count(*) AS rows,"
        " CAST(sum(settled_amount) AS DOUBLE) AS settled_total FROM settlements WHERE txn_id % 50 <> 0"
        " UNION ALL SELECT 'rejected', count(*), NULL FROM settlements WHERE txn_id % 50 = 0"
    ),
    "inject_defects": _base(f"SELECT txn_id, {_STAGED} FROM stg_transactions"),
    "injected_defects_log": _base("SELECT txn_id, defect_type FROM injected_defects"),
    "inject_defects_other_seed": _base(
        "SELECT * FROM (SELECT CASE WHEN defect_type = 'DUP_TXN' THEN txn_id + 1000000000000000 ELSE txn_id END"
        f" AS txn_id, defect_type FROM (SELECT txn_id, CASE {_OTHER_SEED} END AS defect_type FROM"
        f" (SELECT txn_id, (txn_id % 2147483647 + {42 * 16807}) * 1583458089 % 2147483647 AS x FROM clean)))"
        " WHERE defect_type IS NOT NULL"
    ),
    "inject_defects_overlapping": _base(
        "SELECT txn_id, defect_type FROM (SELECT txn_id + 1000000000000000 AS txn_id, 'DUP_TXN' AS defect_type"
        f" FROM clean WHERE {_draw('txn_id', 43)} >= 4 * 2147483.647 AND {_draw('txn_id', 43)} < 6 * 2147483.647"
        f" UNION ALL SELECT txn_id, CASE {_OTHER_SEED} END FROM (SELECT txn_id, y * y % 2147483647 AS x FROM"
        f" (SELECT txn_id, {_draw('txn_id', 42)} AS y FROM (SELECT txn_id FROM clean UNION ALL"
        " SELECT txn_id + 1000000000000000 FROM clean"
        f" WHERE {_draw('txn_id', 43)} >= 4 * 2147483.647 AND {_draw('txn_id', 43)} < 6 * 2147483.647)))"
        " WHERE x < 4 * 2147483.647 OR x >= 6 * 2147483.647) WHERE defect_type IS NOT NULL"
    ),
    "feed_round_trip": _base(f"SELECT txn_id, {_STAGED} FROM stg_transactions"),
    "defect_counts": _base(
        "SELECT defect_type, count(*) AS injected FROM injected_defects GROUP BY defect_type"
    ),
    "dim_customer": _base(f"SELECT {_CUSTOMER} FROM dim_customer"),
    "dim_txn_type": _base(
        "SELECT CAST(type_id AS BIGINT) AS type_id, d.type AS type, direction, count(f.txn_id) AS txns"
        " FROM (VALUES (1, 'CASH_IN', 'CREDIT'), (2, 'CASH_OUT', 'DEBIT'), (3, 'DEBIT', 'DEBIT'),"
        " (4, 'PAYMENT', 'DEBIT'), (5, 'TRANSFER', 'DEBIT')) AS d(type_id, type, direction)"
        " LEFT JOIN fact f ON f.type = d.type GROUP BY ALL"
    ),
    "dim_time": _base(
        "SELECT DISTINCT CAST(step AS BIGINT) AS time_key, CAST(txn_ts AS VARCHAR) AS txn_ts,"
        " extract(hour FROM txn_ts) AS hour_of_day, extract(dow FROM txn_ts) AS day_of_week,"
        " extract(week FROM txn_ts) AS week_num, extract(month FROM txn_ts) AS month_num FROM fact"
    ),
    "fact_transactions": _base(
        f"SELECT txn_id, CAST(txn_ts AS VARCHAR) AS txn_ts, {_STAGED} FROM fact"
    ),
    "pk_violations": _base(
        "SELECT 'customer_master' AS table_name, account_id AS key_value, count(*) AS copies"
        " FROM customer_master GROUP BY ALL HAVING count(*) > 1"
        " UNION ALL SELECT 'settlements', settlement_ref, count(*) FROM settlements"
        " GROUP BY ALL HAVING count(*) > 1"
        " UNION ALL SELECT 'fact_transactions', CAST(txn_id AS VARCHAR), count(*) FROM fact"
        " GROUP BY ALL HAVING count(*) > 1"
    ),
    "catalog_violations": _run(
        "SELECT 'severity' AS check_name, rule_code AS value FROM catalog WHERE rule_id = 5"
        " UNION ALL SELECT 'rule_code', 'NULL_TYPE'"
        " UNION ALL SELECT DISTINCT 'rule_id', CAST(rule_id AS VARCHAR) FROM queue WHERE rule_id = 17"
    ),
    "account_universe": _base(
        "SELECT name_orig AS account_id FROM stg_transactions WHERE name_orig LIKE 'C%'"
        " UNION SELECT name_dest FROM stg_transactions WHERE name_dest LIKE 'C%'"
    ),
    "star_join_daily": _base(
        "SELECT CAST(CAST(f.txn_ts AS DATE) AS VARCHAR) AS txn_date, segment, direction,"
        " count(*) AS txns, CAST(sum(amount) AS DOUBLE) AS total_amount FROM fact f"
        " LEFT JOIN dim_customer c ON c.account_id = f.name_orig"
        " LEFT JOIN (VALUES ('CASH_IN', 'CREDIT'), ('CASH_OUT', 'DEBIT'), ('DEBIT', 'DEBIT'),"
        " ('PAYMENT', 'DEBIT'), ('TRANSFER', 'DEBIT')) AS d(type, direction) ON d.type = f.type"
        " GROUP BY ALL"
    ),
    "rule_catalog": _run(
        "SELECT CAST(c.rule_id AS BIGINT) AS rule_id, c.rule_code AS rule_code, dimension, severity,"
        " c.rule_code <> 'ANOMALY_IFOREST' AS active, count(h.txn_id) AS failing"
        " FROM catalog c LEFT JOIN hits h USING (rule_code) GROUP BY ALL"
    ),
    **{
        f"rule_{code.lower()}": _base(f"SELECT DISTINCT txn_id FROM ({sql})")
        for code, sql in RULES.items()
    },
    "all_exceptions": _run("SELECT rule_code, txn_id FROM hits"),
    "exceptions": _run(
        "SELECT CAST(rule_id AS BIGINT) AS rule_id, txn_id, '2026-01-20 00:00:00' AS detected_at,"
        " 'OPEN' AS status, CAST(NULL AS VARCHAR) AS assigned_to,"
        " CAST(NULL AS VARCHAR) AS resolved_at, CAST(NULL AS VARCHAR) AS note FROM queue"
    ),
    "exceptions_incremental": _run(
        "SELECT CAST(rule_id AS BIGINT) AS rule_id, txn_id FROM queue WHERE txn_id % 2 = 1"
    ),
    "exceptions_by_delta": _run("SELECT CAST(rule_id AS BIGINT) AS rule_id, txn_id FROM queue"),
    "stored_queue": _run(
        "SELECT CAST(rule_id AS BIGINT) AS rule_id, txn_id, CASE WHEN txn_id % 2 = 0 THEN '2026-01-19 00:00:00'"
        " ELSE '2026-01-20 00:00:00' END AS detected_at, 'OPEN' AS status FROM queue"
    ),
    "stored_open_queue": _run(
        "SELECT CAST(rule_id AS BIGINT) AS rule_id, txn_id FROM queue"
        " WHERE txn_id >= 8192 OR (txn_id % 4 <> 0 AND txn_id % 10 <> 0)"
    ),
    "run_log": _run(
        "SELECT CAST(rule_id AS BIGINT) AS rule_id, '2026-01-20 00:00:00' AS run_ts,"
        " checked AS records_checked, failed AS records_failed, failed AS records_failing FROM run"
    ),
    "run_log_second_run": _run(
        "SELECT CAST(rule_id AS BIGINT) AS rule_id, '2026-01-20 00:00:00' AS run_ts,"
        " checked AS records_checked,"
        " (SELECT count(*) FROM hits h WHERE h.rule_code = run.rule_code AND txn_id % 2 = 1)"
        " AS records_failed, failed AS records_failing FROM run"
    ),
    "exception_lifecycle": _run(
        "SELECT CAST(rule_id AS BIGINT) AS rule_id, txn_id, '2026-01-20 00:00:00' AS detected_at,"
        " CASE WHEN txn_id % 20 = 0 THEN 'RESOLVED' WHEN txn_id % 10 = 0 THEN 'ASSIGNED'"
        " ELSE 'OPEN' END AS status,"
        " CASE WHEN txn_id % 10 = 0 THEN concat('analyst', txn_id % 3) END AS assigned_to,"
        " CASE WHEN txn_id % 20 = 0 THEN '2026-01-22 09:00:00' END AS resolved_at,"
        " CASE WHEN txn_id % 20 = 0 THEN 'explained' END AS note FROM queue"
    ),
    "forty_user_rules": _base(
        "SELECT CAST(31 + step % 40 AS BIGINT) AS rule_id, txn_id FROM fact"
        " WHERE step >= 0 AND amount > 1000 * (step % 40)"
    ),
    "twenty_joined_rules": _base(
        "SELECT CAST(31 + 2 * k + side AS BIGINT) AS rule_id, txn_id FROM (SELECT txn_id, type, unnest([0, 1]) AS side,"
        " unnest([name_orig, name_dest]) AS party FROM fact) f JOIN dim_customer d ON d.account_id = f.party"
        " JOIN (VALUES (0, 'REJECTED', 'TRANSFER'), (1, 'REJECTED', 'CASH_OUT'), (2, 'EXPIRED', 'TRANSFER'),"
        " (3, 'EXPIRED', 'CASH_OUT'), (4, 'PENDING', 'TRANSFER'), (5, 'PENDING', 'CASH_OUT')) AS r(k, status, kind)"
        " ON r.status = d.kyc_status AND r.kind = f.type"
        " UNION ALL SELECT 43 + extract(hour FROM txn_ts) - 2, txn_id FROM fact"
        " WHERE extract(hour FROM txn_ts) BETWEEN 2 AND 5 AND amount > 100000"
        " UNION ALL SELECT 47 + step % 4, txn_id FROM fact"
        " WHERE type = 'CASH_IN' AND step >= 0 AND newbalance_orig - oldbalance_org <> amount"
    ),
    "settlement_rules_bucketed": _run(
        "SELECT CAST(rule_id AS BIGINT) AS rule_id, txn_id FROM queue"
        " WHERE rule_code IN ('SETTLEMENT_MISSING', 'SETTLEMENT_AMOUNT_DIFF', 'LATE_SETTLEMENT')"
    ),
    "party_lookups": _base(
        "SELECT lookup, txn_id, CAST(step AS BIGINT) AS step, CAST(amount AS DOUBLE) AS amount FROM ("
        "SELECT 'destination' AS lookup, * FROM fact WHERE name_dest = 'C7' AND step BETWEEN 100 AND 200"
        " UNION ALL SELECT 'origin', * FROM fact WHERE name_orig = 'C7'"
        " UNION ALL SELECT 'transaction', * FROM fact WHERE txn_id = 4242)"
    ),
    "catalog_round_trip": _base(
        f"SELECT CAST(28 AS BIGINT) AS rule_id, txn_id FROM ({_over_deviations(3)})"
        " UNION ALL SELECT 31, txn_id FROM fact WHERE amount > 500000 AND oldbalance_dest < newbalance_dest"
        " UNION ALL SELECT 6, txn_id FROM fact WHERE amount < 0"
    ),
    "custom_sql_rule": _base(
        "SELECT CAST(31 AS BIGINT) AS rule_id, txn_id FROM fact"
        " WHERE amount > 500000 AND oldbalance_dest < newbalance_dest"
        " UNION ALL SELECT 32, txn_id FROM fact WHERE type = 'TRANSFER' AND name_orig IN"
        " (SELECT account_id FROM dim_customer WHERE kyc_status = 'REJECTED')"
        " UNION ALL SELECT 33, txn_id FROM fact WHERE type = 'CASH_IN' AND extract(hour FROM txn_ts) = 3"
    ),
    "recall_literal": _run(
        "SELECT defect_type, count(*) AS injected, count(h.txn_id) AS caught,"
        " round(100.0 * count(h.txn_id) / count(*), 1) AS recall_pct"
        " FROM injected_defects d LEFT JOIN hits h ON h.txn_id = d.txn_id GROUP BY defect_type"
    ),
    "recall_attributed": _run(
        "SELECT defect_type, expected.rule_code AS rule_code, count(*) AS injected,"
        " count(h.txn_id) AS caught, round(100.0 * count(h.txn_id) / count(*), 1) AS recall_pct"
        " FROM injected_defects d JOIN (VALUES ('NULL_AMOUNT', 'NULL_AMOUNT'),"
        " ('NEG_AMOUNT', 'NEG_AMOUNT'), ('DUP_TXN', 'DUP_BUSINESS_KEY'),"
        " ('BAD_ACCT_FORMAT', 'BAD_ACCT_FORMAT'), ('INVALID_TYPE', 'INVALID_TYPE'),"
        " ('BAL_TAMPERING', 'BAL_ORIG_MISMATCH'), ('STEP_OUT_OF_RANGE', 'STEP_OUT_OF_RANGE'),"
        " ('ZERO_AMOUNT', 'ZERO_AMOUNT')) AS expected(defect_type, rule_code) USING (defect_type)"
        " LEFT JOIN hits h ON h.txn_id = d.txn_id AND h.rule_code = expected.rule_code GROUP BY ALL"
    ),
    "mart_rule_scorecard": _run(
        "SELECT rule_code, dimension, severity, '2026-01-20' AS run_date, checked AS records_checked,"
        " failed AS records_failed, round(100.0 * (1 - failed / checked), 3) AS pass_rate_pct FROM run"
    ),
    "mart_exception_ageing": _run("SELECT severity, age_bucket, open_exceptions FROM ageing"),
    "mart_daily_control": _run(
        "SELECT CAST(day AS VARCHAR) AS run_date, dimension, severity, CAST(failed AS BIGINT) AS failed,"
        " round(rate, 3) AS avg_pass_rate_pct, sla_met FROM control"
    ),
    "mart_exception_detail": _run(
        "SELECT q.rule_code AS rule_code, q.dimension AS dimension, q.severity AS severity,"
        " '2026-01-20 00:00:00' AS detected_at, 'OPEN' AS status, CAST(NULL AS VARCHAR) AS assigned_to,"
        " CAST(NULL AS VARCHAR) AS resolved_at, CAST(NULL AS VARCHAR) AS note, f.txn_id AS txn_id,"
        " CAST(step AS BIGINT) AS step, CAST(txn_ts AS VARCHAR) AS txn_ts, type,"
        " CAST(amount AS DOUBLE) AS amount, name_orig, name_dest, CAST(is_fraud AS BIGINT) AS is_fraud,"
        " CAST(is_flagged_fraud AS BIGINT) AS is_flagged_fraud"
        " FROM queue q JOIN fact f ON f.txn_id = q.txn_id"
    ),
    "top_failing_rules": _run(
        "SELECT rule_code, dimension, severity, failed AS records_failed,"
        " round(100.0 * (1 - failed / checked), 3) AS pass_rate_pct"
        " FROM run ORDER BY failed DESC, rule_code LIMIT 10"
    ),
    "top_failing_rules_latest_day": _run(
        "SELECT rule_code, dimension, severity, failed AS records_failed,"
        " round(100.0 * (1 - failed / checked), 3) AS pass_rate_pct FROM day_run"
        " WHERE day = (SELECT max(day) FROM day_run) ORDER BY failed DESC, rule_code LIMIT 10"
    ),
    "control_summary": f"WITH {TABLES}{_HITS},\n{_TOP}\n"
    "SELECT '2026-01-20' AS run_date, CASE WHEN count(*) = 0 THEN"
    " 'No rule failures detected in the latest run. All checks passed.' ELSE concat_ws(chr(10),"
    " 'Daily DQ Report - 2026-01-20',"
    " 'Total exceptions across top rules: ' || format('{:,}', CAST(sum(failed) AS BIGINT)),"
    " 'HIGH severity rules failing: ' || string_agg(rule_code, ', ' ORDER BY failed DESC, rule_code)"
    " FILTER (WHERE severity = 'HIGH'),"
    " 'Worst performing rule: ' || first(rule_code ORDER BY failed DESC, rule_code) || ' ('"
    " || first(dimension ORDER BY failed DESC, rule_code) || ') with '"
    " || format('{:,}', first(failed ORDER BY failed DESC, rule_code)) || ' failures (pass rate: '"
    " || first(rate ORDER BY failed DESC, rule_code) || '%)',"
    " 'Recommended: Review HIGH-severity exceptions first, investigate root cause in source data,"
    " and update remediation plan.') END AS summary FROM top",
    "kpi_pass_rate": _run("SELECT round(1 - sum(failed) / sum(checked), 8) AS pass_rate FROM run"),
    "kpi_open_high": _run(
        "SELECT CAST(sum(open_exceptions) AS BIGINT) AS open_high FROM ageing WHERE severity = 'HIGH'"
    ),
    "kpi_sla_met": _run(
        "SELECT round(count(*) FILTER (WHERE sla_met) / count(*), 8) AS sla_met_share FROM control"
    ),
    "failures_by_dimension": _run(
        "SELECT dimension, CAST(sum(failed) AS BIGINT) AS failed FROM run GROUP BY dimension"
    ),
    "control_trend": _run(
        "SELECT CAST(day AS VARCHAR) AS run_date, CAST(sum(failed) AS BIGINT) AS failed,"
        " CAST(coalesce(sum(failed) FILTER (WHERE severity = 'HIGH'), 0) AS BIGINT) AS failed_high,"
        " count(*) FILTER (WHERE NOT sla_met) AS sla_breaches FROM control GROUP BY day"
    ),
    "rule_date_matrix": _run(
        "SELECT rule_code, "
        + ", ".join(f"CAST(sum(CASE WHEN day = DATE '{d}' THEN failed END) AS BIGINT) AS \"{d}\"" for d in _MATRIX_DAYS)
        + " FROM day_run GROUP BY rule_code"
    ),
    "dest_lookup_laid_out": _base(
        "SELECT type, count(*) AS txn_count FROM fact"
        " WHERE name_dest = 'C7' AND step >= 100 AND step <= 200 GROUP BY type"
    ),
    "dest_lookup": _base(
        "SELECT type, count(*) AS txn_count FROM fact"
        " WHERE name_dest = 'C7' AND step >= 100 AND step <= 200 GROUP BY type"
    ),
    "fraud_subset": _base("SELECT txn_id, CAST(amount AS DOUBLE) AS amount FROM fact WHERE is_fraud = 1"),
    "open_queue": _run("SELECT CAST(rule_id AS BIGINT) AS rule_id, txn_id FROM aged WHERE status = 'OPEN'"),
    "anomaly_features": _base(
        "SELECT txn_id, CAST(is_fraud AS BIGINT) AS is_fraud,"
        " round(ln(1 + CAST(paid AS DOUBLE)), 8) AS log_amt,"
        " CAST(old_o - new_o - paid AS DOUBLE) AS err_orig,"
        " CAST(new_d - old_d - paid AS DOUBLE) AS err_dest,"
        " CAST(old_o AS DOUBLE) AS oldbalance_org,"
        " CAST(old_d AS DOUBLE) AS oldbalance_dest,"
        " round(CASE WHEN old_o > 0 THEN least(10, greatest(-10, CAST(paid AS DOUBLE) / old_o))"
        " ELSE 0 END, 8) AS bal_ratio_orig, "
        + ", ".join(
            f"CAST(coalesce(type, '0') = '{name}' AS BIGINT) AS \"type_{name}\"" for name in _FEATURE_TYPES
        )
        + " FROM (SELECT txn_id, is_fraud, type, greatest(amount, 0) AS paid,"
        " coalesce(oldbalance_org, 0) AS old_o, coalesce(newbalance_orig, 0) AS new_o,"
        " coalesce(oldbalance_dest, 0) AS old_d, coalesce(newbalance_dest, 0) AS new_d"
        " FROM fact WHERE amount IS NOT NULL)"
    ),
    "scores_given_forest": f"WITH RECURSIVE {TABLES},\n{_GIVEN_FOREST}\n"
    "SELECT txn_id, round(pow(2, -(sum(path) / 8) / (2 * (ln(255) + 0.5772156649015329) - 2 * 255.0 / 256)), 8) AS score"
    " FROM way WHERE leaf GROUP BY txn_id",
    "eval_given_scores": _given(
        "SELECT count(*) AS records, count(*) FILTER (WHERE top) AS k, CAST(sum(is_fraud) AS BIGINT) AS frauds,"
        " count(*) FILTER (WHERE top AND is_fraud = 1) AS true_positives,"
        " count(*) FILTER (WHERE top AND is_fraud = 0) AS false_positives,"
        " count(*) FILTER (WHERE NOT top AND is_fraud = 1) AS false_negatives,"
        " count(*) FILTER (WHERE NOT top AND is_fraud = 0) AS true_negatives,"
        " round(avg(is_fraud) FILTER (WHERE top), 4) AS precision_at_k,"
        " round(coalesce(sum(is_fraud) FILTER (WHERE top), 0) / greatest(sum(is_fraud), 1), 4) AS recall_at_k,"
        " round(avg(is_fraud) FILTER (WHERE top) / nullif(avg(is_fraud), 0), 4) AS lift FROM ("
        " SELECT *, row_number() OVER (ORDER BY score DESC, txn_id)"
        " <= greatest(1, CAST(floor(0.005 * (SELECT count(*) FROM given)) AS BIGINT)) AS top FROM given)"
    ),
    "flag_given_scores": _given("SELECT txn_id, score, is_anomaly FROM flagged"),
    "overview_given_scores": _given(
        "SELECT f.txn_id AS txn_id, CAST(txn_ts AS VARCHAR) AS txn_ts, type,"
        " CAST(amount AS DOUBLE) AS amount, name_orig, name_dest, CAST(is_fraud AS BIGINT) AS is_fraud,"
        " g.score AS anomaly_score, is_anomaly FROM fact f JOIN flagged g ON g.txn_id = f.txn_id"
    ),
    "top50_given_scores": _given(
        "SELECT f.txn_id AS txn_id, type, CAST(amount AS DOUBLE) AS amount, g.score AS anomaly_score,"
        " is_anomaly FROM fact f JOIN flagged g ON g.txn_id = f.txn_id"
        " ORDER BY g.score DESC, f.txn_id LIMIT 50"
    ),
    "rule_anomaly_given_scores": _given("SELECT txn_id FROM flagged WHERE is_anomaly"),
    "exceptions_given_scores": _given(
        "SELECT CAST(30 AS BIGINT) AS rule_id, txn_id, '2026-01-20 00:00:00' AS detected_at,"
        " 'OPEN' AS status, CAST(NULL AS VARCHAR) AS assigned_to,"
        " CAST(NULL AS VARCHAR) AS resolved_at, CAST(NULL AS VARCHAR) AS note FROM flagged WHERE is_anomaly"
    ),
    "flag_counts_given_scores": _given(
        "SELECT is_anomaly, count(*) AS txn_count,"
        " round(100 * count(*) / (SELECT count(*) FROM flagged), 8) AS share_pct, min(score) AS min_score,"
        " round(avg(score), 8) AS mean_score, max(score) AS max_score FROM flagged GROUP BY is_anomaly"
    ),
    "by_type_given_scores": _given(
        "SELECT type, count(*) AS anomalies, round(avg(f.score), 8) AS mean_score"
        " FROM flagged f JOIN given g ON g.txn_id = f.txn_id WHERE is_anomaly GROUP BY type"
    ),
    "forest_invariants": "SELECT CAST(200 AS BIGINT) AS trees, CAST(256 AS BIGINT) AS least_rows,"
    " CAST(256 AS BIGINT) AS most_rows, true AS within_depth",
    "histogram_given_scores": _given(
        "SELECT CASE WHEN score < 0 THEN 0 WHEN score >= 1 THEN 21"
        " ELSE CAST(floor(score * 20) AS BIGINT) + 1 END AS bin, is_anomaly, count(*) AS txn_count"
        " FROM flagged GROUP BY ALL"
    ),
}
ORACLES["summary_store"] = ORACLES["control_summary"]
ORACLES["reset_run"] = _run(
    "SELECT CAST(rule_id AS BIGINT) AS rule_id, count(*) AS queued FROM queue GROUP BY rule_id"
)
