"""Catalog: Markdown report, last-round metrics, manifest and client evaluation (build-plan step 9)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskframe.catalog import federated as cf
from riskframe.catalog import fitted as fitted_catalog
from riskframe.catalog.fitted import fitted
from riskframe.catalog.models import FIXTURE_BLENDS, vectors
from riskframe.catalog.prep import txn_model
from riskframe.catalog.sqlparts import R6
from riskframe.operators import metrics as M
from riskframe.operators.features import target_drop_count
from riskframe.operators import mlp
from riskframe.operators import models as ML
from riskframe.operators import report as RP
from riskframe.plans.grouped_training import TrainConfig, client_rows
from riskframe.operators.prep import fit_prep
from riskframe.operators.split import stratified_split
from riskframe.plans.preprocess import build_model_table
from riskframe.session import ensure_checkpoint_dir
from riskframe.sources import fixtures as fx
from riskframe.sources import sinks
from riskframe.sources.sinks import manifest


def q_markdown_report(spark, sf_dir):
    """X9 + S11 lines: top single models and top blends of the score fixture, by F1."""
    s = fx.scores(spark, sf_dir)
    singles = M.model_metrics(s, ["model"])
    hybrids = M.model_metrics(ML.blend_scores(s, FIXTURE_BLENDS), ["model"])
    return RP.comparison_report(singles, hybrids, top_k=RP_TOP_K)


def q_last_round_metrics(spark, sf_dir):
    """Each client's metrics in its last round."""
    out = RP.last_round(cf.client_metrics(spark, sf_dir), ["client_id"])
    return out.select(*[F.round(F.col(c), R6).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])


def q_manifest(spark, sf_dir):
    """The preprocessing manifest as one row (roles, dropped columns, features, class ratios)."""
    split, prep = fitted(spark, sf_dir)
    return manifest(split, prep, txn_model(spark, sf_dir).roles, "Is_Fraud")


def q_manifest_rows(spark, sf_dir):
    """S5 + P6: the manifest as a table, one row per value, with the rows that the label filter left out."""
    raw = fx.txn_raw(spark, sf_dir)
    mt = build_model_table(raw, row_key=fx.ROW_KEYS["txn_raw"])
    split = stratified_split(mt.df)
    prep = fit_prep(split.where(F.col("split") == "train"), mt.numeric, mt.categorical)
    out = sinks.manifest_rows(split, prep, mt.roles, "Is_Fraud", target_drop_count(raw, split))
    return out.withColumn("number", F.round("number", R6))


def q_processed_roundtrip(spark, sf_dir):
    """A committed version is written to shared storage; val features are read back from it, and test rows are
    encoded anew with the statistics and the dictionary read back."""
    split, prep = fitted(spark, sf_dir)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/processed-{uuid.uuid4().hex}"
    sinks.write_version(split, prep, path)
    val = sinks.read_version(spark, path, "val").select("row_id", "split", F.inline(F.arrays_zip(F.col("indices").alias("pos"), F.col("values").alias("value"))))
    test = sinks.load_prep(spark, path).entries(split.where(F.col("split") == "test"), ["row_id", "split"])
    return val.unionByName(test).withColumn("value", F.round("value", R6))


def q_client_evaluation(spark, sf_dir):
    """L2: the initial global model on every client's local validation rows: loss, rows and metrics."""
    v = vectors(spark, sf_dir)
    cfg = TrainConfig()
    d = len(v.select("features").first()["features"])
    val = client_rows(v, cfg).where(F.col("local_split") == "val")
    params = mlp.init_params(d, cfg.hidden, cfg.seed)
    scores = mlp.score_rows(val, {c: params for c in ("w1", "w2", "w3")}, d, key="client_id")
    return (M.threshold_metrics(scores, ["client_id"]).join(M.bce_loss(scores, ["client_id"]), "client_id")
            .join(M.ranking_metrics(scores, ["client_id"]), "client_id"))


RP_TOP_K = 5

QUERIES = {
    "markdown_report": q_markdown_report,
    "last_round_metrics": q_last_round_metrics,
    "manifest": q_manifest,
    "manifest_rows": q_manifest_rows,
    "processed_roundtrip": q_processed_roundtrip,
    "client_evaluation": q_client_evaluation,
}

# ---------------------------------------------------------------------------------------------
# DuckDB oracle


def _report_sql() -> str:
    from riskframe.catalog.models import _blend_sql, _metrics_sql

    def cell(c):
        return f"CAST(round({c}, {RP.DECIMALS}) AS VARCHAR)"

    cols = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]
    row = " || ' | ' || ".join(cell(c) for c in cols)
    metrics = _metrics_sql("allsc", "kind, model").replace(
        "count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn FROM",
        "count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn, "
        "count(*) FILTER (WHERE score < 0.5 AND label <> 1) AS tn FROM")
    return fx.scores_cte() + _blend_sql("scores") + metrics + f"""
, mm AS (SELECT kind, model, (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS accuracy,
    CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END AS precision,
    CASE WHEN tp + fn = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END AS recall, f1, roc_auc, pr_auc FROM m),
rk AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY f1 DESC, model) AS rank FROM mm),
cnt AS (SELECT least(count(*) FILTER (WHERE kind = 'single'), {RP_TOP_K}) AS n1,
               least(count(*) FILTER (WHERE kind = 'hybrid'), {RP_TOP_K}) AS n2 FROM mm),
lines AS (
  SELECT 0 AS line_no, '{RP.TITLE}' AS line UNION ALL SELECT 1, '' UNION ALL SELECT 2, '{RP.SINGLE_TITLE}'
  UNION ALL SELECT 3, '' UNION ALL SELECT 4, '| model | accuracy | precision | recall | f1 | roc_auc | pr_auc |'
  UNION ALL SELECT 5, '| --- | --- | --- | --- | --- | --- | --- |'
  UNION ALL SELECT 5 + rank, '| ' || model || ' | ' || {row} || ' |' FROM rk WHERE kind = 'single' AND rank <= {RP_TOP_K}
  UNION ALL SELECT 6 + n1, '' FROM cnt UNION ALL SELECT 7 + n1, '{RP.HYBRID_TITLE}' FROM cnt
  UNION ALL SELECT 8 + n1, '' FROM cnt
  UNION ALL SELECT 9 + n1, '| hybrid_model | accuracy | precision | recall | f1 | roc_auc | pr_auc |' FROM cnt
  UNION ALL SELECT 10 + n1, '| --- | --- | --- | --- | --- | --- | --- |' FROM cnt
  UNION ALL SELECT 10 + n1 + rank, '| ' || model || ' | ' || {row} || ' |' FROM rk, cnt WHERE kind = 'hybrid' AND rank <= {RP_TOP_K}
  UNION ALL SELECT 11 + n1 + n2, '' FROM cnt)
SELECT CAST(line_no AS INTEGER) AS line_no, line FROM lines"""


ORACLE = {
    "markdown_report": _report_sql(),
    "last_round_metrics": cf._BASE.rstrip().rstrip(",") + f"""
SELECT client_id, round, round(f1, {R6}) AS f1, round(fraud_ratio, {R6}) AS fraud_ratio, n FROM (
  SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY round DESC) AS rk FROM cm) WHERE rk = 1""",
}

_ORDERED = {"dropped_column": ("Customer_ID", "Customer_Name", "Transaction_ID"), "numeric_column": fitted_catalog.TXN_NUMERIC,
            "categorical_column": fitted_catalog.TXN_CATEGORICAL}
_FIXED = [("target_column", 0, "Is_Fraud"), ("amount_column", 0, "Transaction_Amount"), ("balance_column", 0, "Account_Balance"),
          *((entry, i, c) for entry, names in _ORDERED.items() for i, c in enumerate(names))]

ORACLE["manifest_rows"] = fitted_catalog.VECTORS + f"""
, names AS ({fitted_catalog.NAMES}),
g AS (SELECT split, count(*) AS n, count(*) FILTER (WHERE label = 1) AS k FROM split GROUP BY split)
SELECT entry, pos, text, NULL::DOUBLE AS number FROM (VALUES {", ".join(f"('{e}', {i}, '{t}')" for e, i, t in _FIXED)}) AS t(entry, pos, text)
UNION ALL SELECT 'dropped_rows', 0, NULL, (SELECT count(*) FROM txn_raw) - (SELECT count(*) FROM split)
UNION ALL SELECT 'n_features', 0, NULL, (SELECT count(*) FROM names)
UNION ALL SELECT 'feature', pos, feature, NULL FROM names
UNION ALL SELECT 'n', 0, split, n FROM g UNION ALL SELECT 'fraud_count', 0, split, k FROM g
UNION ALL SELECT 'fraud_ratio', 0, split, round(k / n, {R6}) FROM g"""
ORACLE["processed_roundtrip"] = fitted_catalog.ORACLE["prep_vectors"] + " AND sp.split IN ('val', 'test')"
