"""Fixture tables derived from the input tables by SQL text that Spark and DuckDB both run.

Placeholders ``{events}`` etc. name input tables: Spark binds them to DataFrames
(``spark.sql(text, events=df)``, no global views), the DuckDB oracle to its pre-registered views.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from riskframe.sources.tables import read_table

# Raw transactions with planted defects: bad amounts and times, missing balances and categories,
# balance -1 (division by zero) and labels that are not 0/1.  Text fixed by FIXTURES.md.
TXN_RAW_SQL = """
SELECT e.event_id AS Transaction_ID, e.user_id AS Customer_ID, c.c_name AS Customer_Name,
 CAST(CAST(e.ts AS DATE) AS STRING) AS Transaction_Date,
 CASE WHEN e.event_id % 89 = 0 THEN 'n/a' ELSE SUBSTR(CAST(e.ts AS STRING), 12, 8) END AS Transaction_Time,
 CASE WHEN e.event_id % 97 = 0 THEN 'bad' ELSE CAST(e.value AS STRING) END AS Transaction_Amount,
 CASE WHEN e.event_id % 53 = 0 THEN NULL WHEN e.event_id % 211 = 0 THEN -1.0 ELSE c.c_acctbal END AS Account_Balance,
 CASE WHEN e.event_id % 41 = 0 THEN NULL ELSE e.event_type END AS Transaction_Type,
 c.c_mktsegment AS Segment, n.n_name AS Nation,
 CASE WHEN e.event_id % 101 = 0 THEN '2' WHEN e.event_id % 103 = 0 THEN 'x'
  WHEN (e.event_type = 'error' AND e.value > 60) OR (e.value > 150 AND EXTRACT(HOUR FROM e.ts) < 6) THEN '1'
  ELSE '0' END AS Is_Fraud
FROM {events} e LEFT JOIN {customer} c ON e.user_id = c.c_custkey LEFT JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""

# Scale fixture: every lineitem with its order.  Amount = extended price, balance = order total,
# a typed timestamp column, label = returned line.
LINEITEM_TXN_SQL = """
SELECT l.l_orderkey * 8 + l.l_linenumber AS Line_ID, o.o_custkey AS Customer_ID,
 l.l_shipdate AS Ship_Timestamp, l.l_extendedprice AS Line_Amount, o.o_totalprice AS Order_Balance,
 l.l_quantity AS Quantity, l.l_discount AS Discount, l.l_tax AS Tax,
 l.l_linestatus AS Line_Status, o.o_orderstatus AS Order_Status, o.o_orderpriority AS Priority,
 CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS Is_Fraud
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
"""

# Row key of each fixture (kept as ``row_id``; the identity drop removes the original column).
ROW_KEYS = {"txn_raw": "Transaction_ID", "lineitem_txn": "Line_ID"}

# Kept rows of txn_raw with fixed score expressions: (row_id, label, model, score), scores rounded to
# three digits so that ties occur.  Used by the metric, blend and ranking queries.
SCORES_SQL = """
SELECT row_id, label, model, score FROM (
 SELECT row_id, label, 'amount_logit' AS model, ROUND(1.0 / (1.0 + EXP(-(amount - 60.0) / 30.0)), 3) AS score FROM kept
 UNION ALL
 SELECT row_id, label, 'type_amount' AS model,
  ROUND(1.0 / (1.0 + EXP(-(amount - 60.0) / 20.0 - CASE WHEN ttype = 'error' THEN 2.0 ELSE -1.0 END)), 3) AS score FROM kept
 UNION ALL
 SELECT row_id, label, 'night_amount' AS model,
  ROUND(1.0 / (1.0 + EXP(-(amount - 150.0) / 40.0 - CASE WHEN hh < 6 THEN 1.5 ELSE 0.0 END)), 3) AS score FROM kept
 UNION ALL
 SELECT row_id, label, 'balance_gap' AS model,
  ROUND(1.0 / (1.0 + EXP(-(amount - COALESCE(balance, 0.0) / 50.0) / 40.0)), 3) AS score FROM kept
) s WHERE score IS NOT NULL
"""

KEPT_SQL = """
SELECT Transaction_ID AS row_id, CAST(TRY_CAST(Is_Fraud AS DOUBLE) AS INT) AS label,
 TRY_CAST(Transaction_Amount AS DOUBLE) AS amount, Account_Balance AS balance,
 Transaction_Type AS ttype, TRY_CAST(SUBSTR(Transaction_Time, 1, 2) AS INT) AS hh
FROM txn_raw WHERE TRY_CAST(Is_Fraud AS DOUBLE) IN (0, 1)
"""

def _fields(text: str) -> list[str]:
    return [f for _, f, _, _ in string.Formatter().parse(text) if f]


def spark_sql(spark: SparkSession, sf_dir: str, text: str, **frames: DataFrame) -> DataFrame:
    """Run fixture SQL in Spark, binding each ``{table}`` placeholder to a DataFrame."""
    binds = {}
    for name in _fields(text):
        binds[name] = frames[name] if name in frames else read_table(spark, sf_dir, name)
    return spark.sql(text, **binds)


def duckdb_sql(text: str) -> str:
    """The same SQL text for the DuckDB oracle (placeholders become the pre-registered view names)."""
    return text.format(**{name: name for name in _fields(text)})


def txn_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_sql(spark, sf_dir, TXN_RAW_SQL)


def lineitem_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_sql(spark, sf_dir, LINEITEM_TXN_SQL)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``scores`` fixture: kept txn_raw rows with four fixed score expressions."""
    raw = txn_raw(spark, sf_dir)
    kept = spark.sql(KEPT_SQL.replace("FROM txn_raw", "FROM {txn_raw}"), txn_raw=raw)
    return spark.sql(SCORES_SQL.replace("FROM kept", "FROM {kept}"), kept=kept)


def scores_cte() -> str:
    """DuckDB ``WITH`` prefix defining txn_raw, kept and scores."""
    return (f"WITH txn_raw AS ({duckdb_sql(TXN_RAW_SQL)}), kept AS ({KEPT_SQL}), "
            f"scores AS ({SCORES_SQL}) ")


# Supplied coefficient tables of three linear models over the features of the txn model table: (model, feature, coefficient).
# One name is of no feature, so it has no effect.
LINEAR_MODELS = (
    ("linear_amount", "(intercept)", -2.0), ("linear_amount", "num__Transaction_Amount", 1.4), ("linear_amount", "num__log_amount", 0.6),
    ("linear_amount", "num__Account_Balance", -0.05), ("linear_amount", "cat__Segment_BUILDING", 0.1),
    ("linear_type", "(intercept)", -2.5), ("linear_type", "cat__Transaction_Type_error", 3.5), ("linear_type", "num__Transaction_Amount", 0.8),
    ("linear_type", "cat__Transaction_Type_click", -0.4), ("linear_type", "cat__Nation_FRANCE", 0.2), ("linear_type", "cat__Nation_nowhere", 9.0),
    ("linear_night", "(intercept)", -1.8), ("linear_night", "num__is_night", 0.9), ("linear_night", "num__tx_hour", -0.2),
    ("linear_night", "num__log_amount", 0.7), ("linear_night", "num__amount_to_balance_ratio", 0.01),
)
LINEAR_BLENDS = (("linear_amount", "linear_type", 0.7, 0.3), ("linear_amount", "linear_night", 0.6, 0.4))


def linear_models(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LINEAR_MODELS), "model string, feature string, coef double")


def linear_models_sql() -> str:
    return "SELECT * FROM (VALUES " + ", ".join(f"('{m}', '{f}', {c!r}::DOUBLE)" for m, f, c in LINEAR_MODELS) + ") AS t(model, feature, coef)"
