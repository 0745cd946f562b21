"""Catalog: metrics over score tables (build-plan step 5) and the flagship query."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.catalog import prep
from riskframe.catalog.prep import txn_split
from riskframe.catalog.sqlparts import R6, SPLIT_CTE, TXN_MODEL_CTE, with_ctes
from riskframe.operators import metrics as M
from riskframe.operators.split import partition_clients
from riskframe.sources import fixtures as fx


def _round_doubles(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(c), R6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def flagship_scores(spark, sf_dir) -> DataFrame:
    """Test rows of the split txn model table scored by a fixed risk expression."""
    test = txn_split(spark, sf_dir).where(F.col("split") == "test")
    z = (F.coalesce(F.col("Transaction_Amount"), F.lit(0.0)) - F.lit(60.0)) / F.lit(30.0)
    return test.select("row_id", "label", F.lit("amount_logit").alias("model"),
                       (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias("score"))


def q_risk_score_test_metrics(spark, sf_dir):
    """Flagship: threshold and ranking metrics of a fixed risk score on the test split."""
    return _round_doubles(M.model_metrics(flagship_scores(spark, sf_dir), ["model"]))


def q_confusion(spark, sf_dir):
    return M.confusion_matrix(fx.scores(spark, sf_dir), ["model"])


def q_threshold_metrics(spark, sf_dir):
    return _round_doubles(M.threshold_metrics(fx.scores(spark, sf_dir), ["model"]))


def q_ranking_metrics(spark, sf_dir):
    return _round_doubles(M.ranking_metrics(fx.scores(spark, sf_dir), ["model"]))


def q_roc_points(spark, sf_dir):
    return _round_doubles(M.roc_points(M.score_curve(fx.scores(spark, sf_dir), ["model"]), ["model"]))


def q_pr_points(spark, sf_dir):
    return _round_doubles(M.pr_points(M.score_curve(fx.scores(spark, sf_dir), ["model"]), ["model"]))


def q_class_report(spark, sf_dir):
    return _round_doubles(M.class_report(fx.scores(spark, sf_dir), ["model"]))


def q_log_loss(spark, sf_dir):
    return _round_doubles(M.log_loss(fx.scores(spark, sf_dir), ["model"]))


def q_bce_loss(spark, sf_dir):
    return _round_doubles(M.bce_loss(fx.scores(spark, sf_dir), ["model"]))


def q_class_weights(spark, sf_dir):
    """A2 + A4 on the train split: balanced weight per class and the negative/positive ratio."""
    train = txn_split(spark, sf_dir).where(F.col("split") == "train")
    per_class = train.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()  # over the two class rows only
    n_neg = F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).over(everything)
    n_pos = F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).over(everything)
    return _round_doubles(per_class.select(
        "label", "n",
        (F.sum("n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("n"))).alias("weight"),
        (n_neg / F.greatest(n_pos, F.lit(1))).alias("pos_weight")))


def q_client_balance(spark, sf_dir):
    """A3: rows, positive share and pos_weight of each client's local training rows (bank mix)."""
    train = txn_split(spark, sf_dir).where(F.col("split") == "train").select("row_id", "label")
    parts = partition_clients(train, "bank_noniid").where(F.col("local_split") == "train")
    return _round_doubles(M.client_balance(parts, ["client_id"]))


QUERIES = {
    "risk_score_test_metrics": q_risk_score_test_metrics,
    "confusion": q_confusion,
    "threshold_metrics": q_threshold_metrics,
    "ranking_metrics": q_ranking_metrics,
    "roc_points": q_roc_points,
    "pr_points": q_pr_points,
    "class_report": q_class_report,
    "log_loss": q_log_loss,
    "bce_loss": q_bce_loss,
    "class_weights": q_class_weights,
    "client_balance": q_client_balance,
}

# ---------------------------------------------------------------------------------------------
# DuckDB oracle: plain windows over distinct scores (no buckets), computed independently.

_S = fx.scores_cte()
_R = R6

CURVE_CTE = """
, d AS (SELECT model, score, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS pos,
               CAST(count(*) FILTER (WHERE label <> 1) AS DOUBLE) AS neg FROM {src} GROUP BY model, score),
c AS (SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
              sum(neg) OVER (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
              sum(pos) OVER (PARTITION BY model) AS n_pos, sum(neg) OVER (PARTITION BY model) AS n_neg FROM d)
"""

CONF_CTE = """
, k AS (SELECT model,
   count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp, count(*) FILTER (WHERE score >= 0.5 AND label <> 1) AS fp,
   count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn, count(*) FILTER (WHERE score < 0.5 AND label <> 1) AS tn
   FROM {src} GROUP BY model)
"""

_THRESH_SELECT = f"""
SELECT model, tp + fp + fn + tn AS n,
  round(CASE WHEN tp + fp + fn + tn = 0 THEN 0 ELSE (tp + tn)::DOUBLE / (tp + fp + fn + tn) END, {_R}) AS accuracy,
  round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END, {_R}) AS precision,
  round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END, {_R}) AS recall,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2.0 * tp / (2 * tp + fp + fn) END, {_R}) AS f1
FROM k"""

_RANK_SELECT = f"""
SELECT model,
  round(CASE WHEN max(n_pos) > 0 AND max(n_neg) > 0 THEN sum(neg * (tp - pos / 2.0)) / (max(n_pos) * max(n_neg)) END, {_R}) AS roc_auc,
  round(CASE WHEN max(n_pos) > 0 THEN sum(pos * tp / (tp + fp)) / max(n_pos) END, {_R}) AS pr_auc
FROM c GROUP BY model"""

_FLAG = with_ctes(TXN_MODEL_CTE, SPLIT_CTE) + """
, fs AS (SELECT row_id, label, 'amount_logit' AS model,
   1.0 / (1.0 + exp(-((coalesce(Transaction_Amount, 0.0) - 60.0) / 30.0))) AS score FROM split WHERE split = 'test')
"""

ORACLE = {
    "risk_score_test_metrics": _FLAG + CURVE_CTE.format(src="fs") + CONF_CTE.format(src="fs")
    + f", t AS ({_THRESH_SELECT}), r AS ({_RANK_SELECT})\nSELECT t.*, r.roc_auc, r.pr_auc FROM t JOIN r USING (model)",
    "confusion": _S + CONF_CTE.format(src="scores") + """
SELECT model, 0 AS label, 0 AS pred, tn AS n FROM k UNION ALL SELECT model, 0, 1, fp FROM k
UNION ALL SELECT model, 1, 0, fn FROM k UNION ALL SELECT model, 1, 1, tp FROM k""",
    "threshold_metrics": _S + CONF_CTE.format(src="scores") + _THRESH_SELECT,
    "ranking_metrics": _S + CURVE_CTE.format(src="scores") + _RANK_SELECT,
    "roc_points": _S + CURVE_CTE.format(src="scores") + f"""
SELECT model, round(fp / n_neg, {_R}) AS fpr, round(tp / n_pos, {_R}) AS tpr, round(score, {_R}) AS threshold FROM c
UNION ALL SELECT DISTINCT model, 0.0::DOUBLE, 0.0::DOUBLE, NULL::DOUBLE FROM c""",
    "pr_points": _S + CURVE_CTE.format(src="scores") + f"""
SELECT model, round(tp / (tp + fp), {_R}) AS precision, round(tp / n_pos, {_R}) AS recall, round(score, {_R}) AS threshold
FROM c
UNION ALL SELECT DISTINCT model, 1.0::DOUBLE, 0.0::DOUBLE, NULL::DOUBLE FROM c""",
    "class_report": _S + CONF_CTE.format(src="scores") + f"""
, m AS (SELECT model, tp, fp, fn, tn, tp + fp + fn + tn AS n, tp + fn AS s1, tn + fp AS s0,
    CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END AS p1, CASE WHEN tp + fn = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END AS r1,
    CASE WHEN tn + fn = 0 THEN 0 ELSE tn::DOUBLE / (tn + fn) END AS p0, CASE WHEN tn + fp = 0 THEN 0 ELSE tn::DOUBLE / (tn + fp) END AS r0,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1_1,
    CASE WHEN 2 * tn + fn + fp = 0 THEN 0 ELSE 2.0 * tn / (2 * tn + fn + fp) END AS f1_0 FROM k)
SELECT model, '0' AS class_name, round(p0, {_R}) AS precision, round(r0, {_R}) AS recall, round(f1_0, {_R}) AS f1, s0 AS support FROM m
UNION ALL SELECT model, '1', round(p1, {_R}), round(r1, {_R}), round(f1_1, {_R}), s1 FROM m
UNION ALL SELECT model, 'accuracy', NULL, NULL, round((tp + tn)::DOUBLE / n, {_R}), n FROM m
UNION ALL SELECT model, 'macro avg', round((p0 + p1) / 2, {_R}), round((r0 + r1) / 2, {_R}), round((f1_0 + f1_1) / 2, {_R}), n FROM m
UNION ALL SELECT model, 'weighted avg', round((p0 * s0 + p1 * s1) / n, {_R}), round((r0 * s0 + r1 * s1) / n, {_R}),
  round((f1_0 * s0 + f1_1 * s1) / n, {_R}), n FROM m""",
    "log_loss": _S + f"""
, p AS (SELECT model, label::DOUBLE AS y, least(greatest(score, {M.FLOAT32_EPS!r}), 1.0 - {M.FLOAT32_EPS!r}) AS q FROM scores)
SELECT model, round(avg(-(y * ln(q) + (1.0 - y) * ln(1.0 - q))), {_R}) AS log_loss FROM p GROUP BY model""",
    "bce_loss": _S + f"""
, p AS (SELECT model, label::DOUBLE AS y,
   CASE WHEN score <= 0 THEN -100.0 ELSE greatest(ln(score), -100.0) END AS lp,
   CASE WHEN score >= 1 THEN -100.0 ELSE greatest(ln(1.0 - score), -100.0) END AS lq FROM scores)
SELECT model, round(avg(-(y * lp + (1.0 - y) * lq)), {_R}) AS bce_loss FROM p GROUP BY model""",
    "class_weights": with_ctes(TXN_MODEL_CTE, SPLIT_CTE) + f"""
, tr AS (SELECT label FROM split WHERE split = 'train'),
cnt AS (SELECT label, count(*) AS n FROM tr GROUP BY label)
SELECT label, n, round((SELECT count(*) FROM tr)::DOUBLE / ((SELECT count(*) FROM cnt) * n), {_R}) AS weight,
  round((SELECT count(*) FILTER (WHERE label = 0) FROM tr)::DOUBLE
        / greatest((SELECT count(*) FILTER (WHERE label = 1) FROM tr), 1), {_R}) AS pos_weight
FROM cnt""",
}

ORACLE["client_balance"] = f"""
SELECT client_id, count(*) AS n, round(avg(CASE WHEN label = 1 THEN 1.0 ELSE 0.0 END), {_R}) AS fraud_ratio,
  round((count(*) FILTER (WHERE label = 0))::DOUBLE / greatest(count(*) FILTER (WHERE label = 1), 1), {_R}) AS pos_weight
FROM ({prep._MIX}) WHERE local_split = 'train' GROUP BY client_id"""
