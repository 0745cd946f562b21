"""Catalog: label filter, features, roles, splits and client partitions (build-plan steps 1-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.catalog.sqlparts import R6, SPLIT_CTE, TXN_MODEL_CTE, with_ctes
from riskframe.functions.hashing import order_hash_sql
from riskframe.operators.features import sanitize_target
from riskframe.operators.metrics import class_ratio
from riskframe.operators.roles import event_time_candidates
from riskframe.operators.split import partition_clients, stratified_split, subsample
from riskframe.plans.preprocess import build_model_table, with_row_id
from riskframe.sources import fixtures as fx
from riskframe.sources.fixtures import LINEITEM_TXN_SQL, duckdb_sql

SUBSAMPLE_N = 5000


def txn_model(spark: SparkSession, sf_dir: str):
    return build_model_table(fx.txn_raw(spark, sf_dir), row_key=fx.ROW_KEYS["txn_raw"])


def txn_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split model table; the split stores its rows in the checkpoint folder, so later passes start there."""
    return stratified_split(txn_model(spark, sf_dir).df)


def _r(c: str) -> F.Column:
    return F.round(F.col(c), R6).alias(c)


# ---------------------------------------------------------------------------------------------


def q_sanitize_target(spark, sf_dir):
    return sanitize_target(fx.txn_raw(spark, sf_dir), "Is_Fraud")


def q_amount_features(spark, sf_dir):
    m = txn_model(spark, sf_dir).df
    return m.select("row_id", *[_r(c) for c in ("Transaction_Amount", "Account_Balance", "amount_to_balance_ratio",
                                                "amount_minus_balance")],
                    "is_over_balance", _r("log_amount"))


def q_time_features(spark, sf_dir):
    m = txn_model(spark, sf_dir).df
    return m.select("row_id", "tx_hour", "tx_day_of_week", "is_weekend", "is_night")


def q_event_timestamp(spark, sf_dir):
    from riskframe.operators.roles import resolve_event_time

    raw = sanitize_target(with_row_id(fx.txn_raw(spark, sf_dir), "Transaction_ID"), "Is_Fraud")
    ts, _ = resolve_event_time(raw.drop("row_id"))
    return raw.select("row_id", ts.alias("event_ts"))


def q_model_table(spark, sf_dir):
    m = txn_model(spark, sf_dir).df
    return m.select(*[_r(c) if t == "double" else F.col(c) for c, t in m.dtypes])


def q_identity_columns(spark, sf_dir):
    """P5 applied: the sanitised raw table without its identifying columns."""
    from riskframe.operators.roles import amount_balance_columns, date_like_columns, drop_identity

    raw = sanitize_target(fx.txn_raw(spark, sf_dir), "Is_Fraud")
    amount, balance = amount_balance_columns(raw.schema)
    out, _ = drop_identity(raw, "Is_Fraud", [amount, balance] + date_like_columns(raw.columns))
    return out


def q_lineitem_roles(spark, sf_dir):
    """P3/P4/P5/P9 on a second schema: amount, balance and a typed timestamp found by name."""
    mt = build_model_table(fx.lineitem_txn(spark, sf_dir), row_key=fx.ROW_KEYS["lineitem_txn"])
    m = mt.df
    return m.select(*[_r(c) if t == "double" else F.col(c) for c, t in m.dtypes])


def q_parse_rates(spark, sf_dir):
    """Share of rows each event-time candidate parses (txn_raw: date + time, and joined text)."""
    raw = sanitize_target(fx.txn_raw(spark, sf_dir), "Is_Fraud")
    _, cands = event_time_candidates(raw)
    aggs = [F.round(F.avg(e.isNotNull().cast("int")), R6).alias(f"r{i}") for i, (_, e) in enumerate(cands)]
    stack = ", ".join(f"'{n}', r{i}" for i, (n, _) in enumerate(cands))
    return raw.agg(*aggs).selectExpr(f"stack({len(cands)}, {stack}) AS (candidate, parse_rate)")


def q_stratified_split(spark, sf_dir):
    return txn_split(spark, sf_dir).select("row_id", "label", "split")


def q_class_ratio(spark, sf_dir):
    r = class_ratio(txn_split(spark, sf_dir), ["split"])
    return r.select("split", "n", "fraud_count", F.round("fraud_ratio", R6).alias("fraud_ratio"))


def _train(spark, sf_dir):
    return txn_split(spark, sf_dir).where(F.col("split") == "train").select("row_id", "label")


def q_partition_iid(spark, sf_dir):
    return partition_clients(_train(spark, sf_dir), "iid")


def q_partition_skew(spark, sf_dir):
    return partition_clients(_train(spark, sf_dir), "noniid")


def q_partition_mix(spark, sf_dir):
    return partition_clients(_train(spark, sf_dir), "bank_noniid")


def q_subsample(spark, sf_dir):
    return subsample(_train(spark, sf_dir), SUBSAMPLE_N)


QUERIES = {
    "sanitize_target": q_sanitize_target,
    "amount_features": q_amount_features,
    "time_features": q_time_features,
    "event_timestamp": q_event_timestamp,
    "model_table": q_model_table,
    "identity_columns": q_identity_columns,
    "lineitem_roles": q_lineitem_roles,
    "parse_rates": q_parse_rates,
    "stratified_split": q_stratified_split,
    "class_ratio": q_class_ratio,
    "partition_iid": q_partition_iid,
    "partition_skew": q_partition_skew,
    "partition_mix": q_partition_mix,
    "subsample": q_subsample,
}

# ---------------------------------------------------------------------------------------------
# DuckDB oracle

_TXN = f"WITH txn_raw AS ({duckdb_sql(fx.TXN_RAW_SQL)})\n"
_MODEL = with_ctes(TXN_MODEL_CTE)
_SPLIT = with_ctes(TXN_MODEL_CTE, SPLIT_CTE)
_TRAIN = with_ctes(TXN_MODEL_CTE, SPLIT_CTE, "train AS (SELECT row_id, label FROM split WHERE split = 'train')")

_IID_CTE = f"""
o AS (SELECT row_id, label, {order_hash_sql('row_id', 42)} AS h FROM train),
r AS (SELECT *, ntile(3) OVER (ORDER BY {{order}}) AS part FROM o),
c AS (SELECT *, 'w' || CAST(part AS VARCHAR) AS client_id,
        row_number() OVER (PARTITION BY part ORDER BY {{order}}) AS rk,
        count(*) OVER (PARTITION BY part) AS n_c FROM r)
SELECT row_id, label, client_id,
  CASE WHEN rk <= floor(n_c * 0.85::DOUBLE) THEN 'train' ELSE 'val' END AS local_split FROM c
"""

_MIX = _TRAIN.rstrip() + f""",
o AS (SELECT row_id, label, {order_hash_sql('row_id', 42)} AS h, {order_hash_sql('row_id', 42, 'mix')} AS h2 FROM train),
r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY h, row_id) AS rk,
        count(*) OVER (PARTITION BY label) AS n_l FROM o),
s AS (SELECT *,
   CASE WHEN label = 1 THEN floor(n_l * 0.15::DOUBLE) ELSE floor(n_l * 0.45::DOUBLE) END AS c1,
   CASE WHEN label = 1 THEN floor(n_l * 0.30::DOUBLE) ELSE floor(n_l * 0.35::DOUBLE) END AS c2 FROM r),
p AS (SELECT row_id, label, h2,
   CASE WHEN rk <= c1 THEN 'w1' WHEN rk <= c1 + c2 THEN 'w2' ELSE 'w3' END AS client_id FROM s),
q AS (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY h2, row_id) AS rk2,
        count(*) OVER (PARTITION BY client_id) AS n_c FROM p)
SELECT row_id, label, client_id,
  CASE WHEN rk2 <= floor(n_c * 0.85::DOUBLE) THEN 'train' ELSE 'val' END AS local_split FROM q
"""

_R = R6

ORACLE = {
    "sanitize_target": _TXN + """
SELECT * REPLACE (CAST(TRY_CAST(Is_Fraud AS DOUBLE) AS INTEGER) AS Is_Fraud) FROM txn_raw
WHERE TRY_CAST(Is_Fraud AS DOUBLE) IN (0, 1)""",
    "amount_features": _MODEL + f"""
SELECT row_id, round(Transaction_Amount, {_R}) AS Transaction_Amount, round(Account_Balance, {_R}) AS Account_Balance,
  round(amount_to_balance_ratio, {_R}) AS amount_to_balance_ratio, round(amount_minus_balance, {_R}) AS amount_minus_balance,
  is_over_balance, round(log_amount, {_R}) AS log_amount FROM model""",
    "time_features": _MODEL + "SELECT row_id, tx_hour, tx_day_of_week, is_weekend, is_night FROM model",
    "event_timestamp": _MODEL + "SELECT row_id, ts AS event_ts FROM model",
    "model_table": _MODEL + f"""
SELECT row_id, round(Transaction_Amount, {_R}) AS Transaction_Amount, round(Account_Balance, {_R}) AS Account_Balance,
  Transaction_Type, Segment, Nation,
  round(amount_to_balance_ratio, {_R}) AS amount_to_balance_ratio, round(amount_minus_balance, {_R}) AS amount_minus_balance,
  is_over_balance, round(log_amount, {_R}) AS log_amount, tx_hour, tx_day_of_week, is_weekend, is_night, label
FROM model""",
    "identity_columns": _TXN + """
SELECT Transaction_Date, Transaction_Time, Transaction_Amount, Account_Balance, Transaction_Type, Segment, Nation,
  CAST(TRY_CAST(Is_Fraud AS DOUBLE) AS INTEGER) AS Is_Fraud
FROM txn_raw WHERE TRY_CAST(Is_Fraud AS DOUBLE) IN (0, 1)""",
    "lineitem_roles": f"WITH li AS ({duckdb_sql(LINEITEM_TXN_SQL)})\n" + f"""
SELECT CAST(Line_ID AS BIGINT) AS row_id, round(Line_Amount, {_R}) AS Line_Amount, round(Order_Balance, {_R}) AS Order_Balance,
  round(Quantity, {_R}) AS Quantity, round(Discount, {_R}) AS Discount, round(Tax, {_R}) AS Tax,
  Line_Status, Order_Status, Priority,
  round(CASE WHEN Order_Balance + 1.0 = 0 THEN NULL ELSE Line_Amount / (Order_Balance + 1.0) END, {_R}) AS amount_to_balance_ratio,
  round(Line_Amount - Order_Balance, {_R}) AS amount_minus_balance,
  CASE WHEN Line_Amount > Order_Balance THEN 1 ELSE 0 END AS is_over_balance,
  round(ln(1 + greatest(Line_Amount, 0.0)), {_R}) AS log_amount,
  CAST(hour(Ship_Timestamp) AS INTEGER) AS tx_hour, CAST(isodow(Ship_Timestamp) - 1 AS INTEGER) AS tx_day_of_week,
  CAST(CASE WHEN isodow(Ship_Timestamp) - 1 >= 5 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS is_weekend,
  CAST(CASE WHEN hour(Ship_Timestamp) IN (0, 1, 2, 3, 4, 5) THEN 1.0 ELSE 0.0 END AS DOUBLE) AS is_night,
  Is_Fraud AS label
FROM li""",
    "parse_rates": _TXN + f"""
, s AS (SELECT * FROM txn_raw WHERE TRY_CAST(Is_Fraud AS DOUBLE) IN (0, 1))
SELECT 'Transaction_Date + Transaction_Time' AS candidate,
  round(avg(CASE WHEN TRY_CAST(Transaction_Date AS TIMESTAMP) + TRY_CAST(Transaction_Time AS INTERVAL) IS NOT NULL THEN 1 ELSE 0 END), {_R}) AS parse_rate FROM s
UNION ALL
SELECT 'text(Transaction_Date Transaction_Time)' AS candidate,
  round(avg(CASE WHEN TRY_CAST(concat_ws(' ', Transaction_Date, Transaction_Time) AS TIMESTAMP) IS NOT NULL THEN 1 ELSE 0 END), {_R}) AS parse_rate FROM s""",
    "stratified_split": _SPLIT + "SELECT row_id, label, split FROM split",
    "class_ratio": _SPLIT + f"""
SELECT split, count(*) AS n, CAST(sum(label) AS BIGINT) AS fraud_count, round(avg(label::DOUBLE), {_R}) AS fraud_ratio
FROM split GROUP BY split""",
    "partition_iid": _TRAIN.rstrip() + ",\n" + _IID_CTE.replace("{order}", "h, row_id"),
    "partition_skew": _TRAIN.rstrip() + ",\n" + _IID_CTE.replace("{order}", "label, h, row_id"),
    "partition_mix": _MIX,
    "subsample": _TRAIN + f"""
SELECT row_id, label FROM (
  SELECT row_id, label, row_number() OVER (ORDER BY {order_hash_sql('row_id', 42, 'subsample')}, row_id) AS rk FROM train)
WHERE rk <= {SUBSAMPLE_N}""",
}
