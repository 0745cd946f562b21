"""DuckDB SQL building blocks for the oracle: the txn_raw model table and split, written independently
of the Spark code (plain windows, no buckets) so that the two implementations check each other."""

from __future__ import annotations

from riskframe.functions.hashing import order_hash_sql
from riskframe.sources.fixtures import TXN_RAW_SQL, duckdb_sql

R6 = 6  # decimals kept on computed doubles on both sides

TXN_MODEL_CTE = f"""
txn_raw AS ({duckdb_sql(TXN_RAW_SQL)}),
san AS (
  SELECT *, CAST(TRY_CAST(Is_Fraud AS DOUBLE) AS INTEGER) AS label FROM txn_raw
  WHERE TRY_CAST(Is_Fraud AS DOUBLE) IN (0, 1)),
base AS (
  SELECT Transaction_ID AS row_id, TRY_CAST(Transaction_Amount AS DOUBLE) AS a, CAST(Account_Balance AS DOUBLE) AS b,
    TRY_CAST(Transaction_Date AS TIMESTAMP) + TRY_CAST(Transaction_Time AS INTERVAL) AS ts,
    Transaction_Type, Segment, Nation, label
  FROM san),
model AS (
  SELECT row_id, a AS Transaction_Amount, b AS Account_Balance, Transaction_Type, Segment, Nation,
    CASE WHEN b + 1.0 = 0 THEN NULL ELSE a / (b + 1.0) END AS amount_to_balance_ratio,
    a - b AS amount_minus_balance,
    CASE WHEN a > b THEN 1 ELSE 0 END AS is_over_balance,
    CASE WHEN a IS NULL THEN NULL ELSE ln(1 + greatest(a, 0.0)) END AS log_amount,
    CAST(hour(ts) AS INTEGER) AS tx_hour,
    CAST(isodow(ts) - 1 AS INTEGER) AS tx_day_of_week,
    CAST(CASE WHEN isodow(ts) - 1 >= 5 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS is_weekend,
    CAST(CASE WHEN hour(ts) IN (0, 1, 2, 3, 4, 5) THEN 1.0 ELSE 0.0 END AS DOUBLE) AS is_night,
    label, ts
  FROM base)
"""

SPLIT_CTE = f"""
hashed AS (SELECT *, {order_hash_sql('row_id', 42)} AS h FROM model),
ranked AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, row_id) AS rk,
                  count(*) OVER (PARTITION BY label) AS n_cls FROM hashed),
split AS (
  SELECT * EXCLUDE (h, rk, n_cls),
    CASE WHEN rk <= n_cls * 70 // 100 THEN 'train'
         WHEN rk <= n_cls * 70 // 100 + (n_cls - n_cls * 70 // 100) * 50 // 100 THEN 'val'
         ELSE 'test' END AS split
  FROM ranked)
"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip().rstrip(",") for p in parts) + "\n"
