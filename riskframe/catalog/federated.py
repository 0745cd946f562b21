"""Catalog: parameter averaging, adaptive client weights and seeded masks (build-plan step 7)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.catalog.sqlparts import R6
from riskframe.functions.hashing import gaussian_noise_sql
from riskframe.operators import federated as FD
from riskframe.operators.rank import ordered_row_number
from riskframe.session import ensure_checkpoint_dir, materialize
from riskframe.sources import fixtures as fx
from riskframe.sources.tables import read_table

# Per (day of month, client) aggregates of the kept txn_raw rows: F1 of the rule ``amount >= 60``,
# positive share and row count.  Client = customer id mod 3.  Text shared by Spark and DuckDB.
CLIENT_METRICS_SQL = """
SELECT round, client_id,
  CASE WHEN 2 * tp + fp + fn = 0 THEN CAST(0 AS DOUBLE)
       ELSE 2 * CAST(tp AS DOUBLE) / CAST(2 * tp + fp + fn AS DOUBLE) END AS f1,
  CAST(pos AS DOUBLE) / CAST(n AS DOUBLE) AS fraud_ratio, n
FROM (
  SELECT CAST(EXTRACT(DAY FROM CAST(Transaction_Date AS DATE)) AS INT) AS round,
    'w' || CAST(Customer_ID % 3 + 1 AS STRING) AS client_id,
    COUNT(*) AS n,
    CAST(SUM(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
    CAST(SUM(CASE WHEN pred = 1 AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
    CAST(SUM(CASE WHEN pred = 1 AND label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
    CAST(SUM(CASE WHEN pred = 0 AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn
  FROM (
    SELECT Transaction_Date, Customer_ID, CAST(TRY_CAST(Is_Fraud AS DOUBLE) AS INT) AS label,
      CASE WHEN TRY_CAST(Transaction_Amount AS DOUBLE) >= 60 THEN 1 ELSE 0 END AS pred
    FROM {txn_raw} WHERE TRY_CAST(Is_Fraud AS DOUBLE) IN (0, 1)) t
  GROUP BY 1, 2) g
"""

CLIENTS = ("w1", "w2", "w3")
# Days that every month has: the rounds that all clients take part in.
ROUNDS = 28


def client_metrics(spark, sf_dir) -> DataFrame:
    return fx.spark_sql(spark, sf_dir, CLIENT_METRICS_SQL, txn_raw=fx.txn_raw(spark, sf_dir))


def params(spark, sf_dir) -> DataFrame:
    """Parameter vectors ``(round, client_id, layer, idx, value)`` from ``embeddings``: client = label
    mod 3; the vectors of a client in order of vec_id fill rounds 1..ROUNDS of layer 0, then of layer 1, and so on, so
    every vector counts."""
    emb = read_table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", F.concat(F.lit("w"), (F.col("label") % 3 + 1).cast("string")).alias("client_id"))
    # rn = row_number() over (partition by client order by vec_id), without a task per client
    return (ordered_row_number(emb, ["client_id"], "vec_id", "rn")
            .withColumn("round", ((F.col("rn") - 1) % ROUNDS + 1).cast("int")).withColumn("layer", F.expr(f"cast((rn - 1) div {ROUNDS} as int)"))
            .select("round", "client_id", "layer", F.posexplode("embedding").alias("idx", "v"))
            .select("round", "client_id", "layer", "idx", F.col("v").cast("double").alias("value")))


def scored_clients(spark, sf_dir) -> DataFrame:
    m = client_metrics(spark, sf_dir)
    return m.select("round", "client_id", FD.client_score(m).alias("score"))


def weights(spark, sf_dir) -> DataFrame:
    return FD.adaptive_weights(scored_clients(spark, sf_dir))


def _r(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(c), R6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def q_client_metrics(spark, sf_dir):
    return _r(client_metrics(spark, sf_dir))


def q_fedavg(spark, sf_dir):
    return _r(FD.fedavg(params(spark, sf_dir), client_metrics(spark, sf_dir)))


def q_client_score(spark, sf_dir):
    return _r(scored_clients(spark, sf_dir))


def q_client_weights(spark, sf_dir):
    return _r(weights(spark, sf_dir))


def q_client_weights_stepwise(spark, sf_dir):
    """The same weights, one step per round from the stored state of the round before."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/client-weights-{uuid.uuid4().hex}"
    return _r(FD.stepwise_weights(materialize(scored_clients(spark, sf_dir)), path))


def q_weighted_average(spark, sf_dir):
    return _r(FD.weighted_average(params(spark, sf_dir), weights(spark, sf_dir)))


def q_mask_params(spark, sf_dir):
    return _r(FD.mask_params(params(spark, sf_dir)))


def q_unmasked_average(spark, sf_dir):
    masked = FD.mask_params(params(spark, sf_dir))
    return _r(FD.unmasked_average(masked, weights(spark, sf_dir)))


def q_weights_wide(spark, sf_dir):
    return _r(FD.weights_wide(weights(spark, sf_dir), CLIENTS))


QUERIES = {
    "client_metrics": q_client_metrics,
    "fedavg": q_fedavg,
    "client_score": q_client_score,
    "client_weights": q_client_weights,
    "client_weights_stepwise": q_client_weights_stepwise,
    "weighted_average": q_weighted_average,
    "mask_params": q_mask_params,
    "unmasked_average": q_unmasked_average,
    "weights_wide": q_weights_wide,
}

# ---------------------------------------------------------------------------------------------
# DuckDB oracle.  The adaptive weights are a recursive CTE over rounds (one iteration per round).

_R = R6
_D = "::DOUBLE"

_BASE = f"""WITH RECURSIVE txn_raw AS ({fx.duckdb_sql(fx.TXN_RAW_SQL)}),
cm AS ({fx.duckdb_sql(CLIENT_METRICS_SQL)}),
p0 AS (SELECT 'w' || CAST(label % 3 + 1 AS VARCHAR) AS client_id, vec_id, embedding,
         row_number() OVER (PARTITION BY label % 3 ORDER BY vec_id) AS rnd FROM embeddings),
params AS (SELECT CAST((rnd - 1) % {ROUNDS} + 1 AS INTEGER) AS round, client_id, CAST((rnd - 1) // {ROUNDS} AS INTEGER) AS layer,
             CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS idx, CAST(unnest(embedding) AS DOUBLE) AS value FROM p0),
sc AS (SELECT round, client_id, greatest(f1, 1e-8{_D}) * (1.0{_D} + {FD.ALPHA_FRAUD!r}{_D} * fraud_ratio) AS score FROM cm),
ri AS (SELECT *, dense_rank() OVER (ORDER BY round) AS ri FROM sc),
"""


def _step(src: str) -> str:
    def norm(x: str) -> str:
        return (f"CASE WHEN sum(greatest({x}, 0{_D})) OVER (PARTITION BY ri) <= 0 THEN 1.0{_D} / count(*) OVER (PARTITION BY ri) "
                f"ELSE greatest({x}, 0{_D}) / sum(greatest({x}, 0{_D})) OVER (PARTITION BY ri) END")

    return f"""
SELECT ri, round, client_id, score, {norm('m2')} AS weight FROM (
  SELECT *, greatest(0.5{_D} * base + 0.5{_D} * adap, {FD.MIN_CLIENT_WEIGHT!r}{_D}) AS m2 FROM (
    SELECT *, {norm('score')} AS base, {norm('araw')} AS adap FROM (
      SELECT *, pw + {FD.ADAPT_LR!r}{_D} * (score - ps) AS araw FROM ({src}) s0) s1) s2) s3"""


_WEIGHTS = _BASE + f"""st AS (
  {_step(f"SELECT ri.*, 1.0{_D} / count(*) OVER () AS pw, score AS ps FROM ri WHERE ri = 1")}
  UNION ALL
  {_step("SELECT n.*, st.weight AS pw, st.score AS ps FROM ri n JOIN st ON n.ri = st.ri + 1 AND n.client_id = st.client_id")}
),
wt AS (SELECT round, client_id, score, weight FROM st)
"""

_MASK = gaussian_noise_sql(
    "('0x' || substr(sha256(concat_ws(':', client_id, CAST(round AS VARCHAR), '2026')), 9, 8))::BIGINT", "layer", "idx")

ORACLE = {
    "client_metrics": _BASE.rstrip().rstrip(",") + f"""
SELECT round, client_id, round(f1, {_R}) AS f1, round(fraud_ratio, {_R}) AS fraud_ratio, n FROM cm""",
    "fedavg": _BASE.rstrip().rstrip(",") + f"""
SELECT p.round, p.layer, p.idx, round(sum(cm.n * p.value) / sum(cm.n), {_R}) AS value
FROM params p JOIN cm ON cm.round = p.round AND cm.client_id = p.client_id GROUP BY p.round, p.layer, p.idx""",
    "client_score": _BASE.rstrip().rstrip(",") + f"\nSELECT round, client_id, round(score, {_R}) AS score FROM sc",
    "client_weights": _WEIGHTS + f"SELECT round, client_id, round(score, {_R}) AS score, round(weight, {_R}) AS weight FROM wt",
    "weighted_average": _WEIGHTS + f"""
SELECT p.round, p.layer, p.idx, round(sum(wt.weight * p.value), {_R}) AS value
FROM params p JOIN wt ON wt.round = p.round AND wt.client_id = p.client_id GROUP BY p.round, p.layer, p.idx""",
    "mask_params": _BASE.rstrip().rstrip(",") + f"""
SELECT round, client_id, layer, idx, round(value + {FD.MASK_SCALE!r}{_D} * {_MASK}, {_R}) AS value FROM params""",
    "unmasked_average": _WEIGHTS + f"""
SELECT p.round, p.layer, p.idx, round(sum(wt.weight * p.value), {_R}) AS value
FROM params p JOIN wt ON wt.round = p.round AND wt.client_id = p.client_id GROUP BY p.round, p.layer, p.idx""",
    "weights_wide": _WEIGHTS + "SELECT round, " + ", ".join(
        f"round(max(weight) FILTER (WHERE client_id = '{c}'), {_R}) AS {c}_weight, "
        f"round(max(score) FILTER (WHERE client_id = '{c}'), {_R}) AS {c}_score" for c in CLIENTS) + " FROM wt GROUP BY round",
}
ORACLE["client_weights_stepwise"] = ORACLE["client_weights"]
