"""Catalog: model fitting (rows-only), blends, ranking and best-model choice (build-plan steps 6, 9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.catalog import metrics as cm
from riskframe.catalog import fitted as fitted_catalog
from riskframe.catalog.fitted import fitted
from riskframe.catalog.prep import txn_split
from riskframe.catalog.sqlparts import R6, SPLIT_CTE, TXN_MODEL_CTE, with_ctes
from riskframe.operators import metrics as M
from riskframe.operators import models as ML
from riskframe.operators import scoring as SC
from riskframe.operators.split import training_sample
from riskframe.plans.compare import central_baseline, run_comparison
from riskframe.session import materialize
from riskframe.sources import fixtures as fx

MAX_TRAIN_SAMPLES = 60_000  # the reference's default training cap (0 = all rows)

# Blends over the fixture's score models: (a, b, weight a, weight b).
FIXTURE_BLENDS = (("type_amount", "amount_logit", 0.7, 0.3), ("type_amount", "night_amount", 0.6, 0.4))
TOP_K = 5


def vectors(spark, sf_dir) -> DataFrame:
    """Every split's feature vectors (train-fitted), checkpointed: several estimators read them."""
    split, prep = fitted(spark, sf_dir)
    return materialize(prep.transform(split).select("row_id", "split", "label", "features"))


def _train_test(spark, sf_dir):
    v = vectors(spark, sf_dir)
    train = training_sample(v.where(F.col("split") == "train"), MAX_TRAIN_SAMPLES)
    return train, v.where(F.col("split") == "test")


def _fit_and_report(spark, sf_dir, fit, name):
    train, test = _train_test(spark, sf_dir)
    model = fit(train)
    return cm._round_doubles(M.model_metrics(ML.positive_scores(model, test, name), ["model"]))


def q_fit_logistic(spark, sf_dir):
    return _fit_and_report(spark, sf_dir, ML.fit_logistic, "logistic_regression")


def q_fit_forest(spark, sf_dir):
    return _fit_and_report(spark, sf_dir, ML.fit_forest, "random_forest")


def q_fit_boosted(spark, sf_dir):
    return _fit_and_report(spark, sf_dir, ML.fit_boosted, "gradient_boosted_trees")


def q_fit_tree(spark, sf_dir):
    return _fit_and_report(spark, sf_dir, ML.fit_tree, "decision_tree")


def q_fit_svm_calibrated(spark, sf_dir):
    return _fit_and_report(spark, sf_dir, ML.fit_svm_calibrated, "svm_linear_calibrated")


def q_linear_score(spark, sf_dir):
    """M8: test rows scored inside the row by the logistic model's coefficients, given as a table."""
    split, prep = fitted(spark, sf_dir)
    v = materialize(prep.transform(split.where(F.col("split") == "train")).select("row_id", "label", "features"))
    lr = ML.fit_logistic(training_sample(v, MAX_TRAIN_SAMPLES))
    by_pos = spark.createDataFrame([(i, float(c)) for i, c in enumerate(lr.coefficients.toArray())], "pos int, coef double")
    coefs = (prep.names().join(by_pos, "pos").select(F.lit("score").alias("model"), "feature", "coef")
             .unionByName(spark.createDataFrame([("score", SC.INTERCEPT, float(lr.intercept))], "model string, feature string, coef double")))
    out = SC.linear_wide(prep, split.where(F.col("split") == "test"), coefs, ("row_id",))
    return out.select("row_id", F.round("score", R6).alias("score"))


def _linear_rows(spark, sf_dir):
    """Every val and test row with its score under each supplied linear model, rounded so that both engines tie alike."""
    split, prep = fitted(spark, sf_dir)
    wide = SC.linear_wide(prep, split.where(F.col("split").isin("val", "test")), fx.linear_models(spark), ("row_id", "label", "split"))
    names = sorted({m for m, _, _ in fx.LINEAR_MODELS})
    return split, names, wide.select("row_id", "label", "split", *[F.round(m, R6).alias(m) for m in names])


def q_linear_models(spark, sf_dir):
    """M8 on supplied coefficient tables: each row's score under every model."""
    return _linear_rows(spark, sf_dir)[2]


def q_compare_linear(spark, sf_dir):
    """Sections M6-M8, O1, O3 as one plan on supplied coefficient tables: wide scores, blends, stack, one metric job."""
    split, names, wide = _linear_rows(spark, sf_dir)
    scores = SC.stacked(wide, names, fx.LINEAR_BLENDS, ("row_id", "label", "split"))
    return cm._round_doubles(SC.comparison(scores, 0.5, split.where(F.col("split") == "train").count()))


def q_compare_models(spark, sf_dir):
    """The model comparison with all five fitted models and the two blends."""
    return cm._round_doubles(run_comparison(vectors(spark, sf_dir)).metrics)


def q_central_baseline(spark, sf_dir):
    """The central baseline, fitted on all train rows: metrics, class report, confusion grid, ROC and PR points."""
    return cm._round_doubles(central_baseline(vectors(spark, sf_dir)))


# -- blends and ranking on the fixed score table ---------------------------------------------


def all_scores(spark, sf_dir) -> DataFrame:
    s = fx.scores(spark, sf_dir)
    return s.withColumn("kind", F.lit("single")).unionByName(
        ML.blend_scores(s, FIXTURE_BLENDS).withColumn("kind", F.lit("hybrid")))


def q_blend_scores(spark, sf_dir):
    b = ML.blend_scores(fx.scores(spark, sf_dir), FIXTURE_BLENDS)
    return b.select("row_id", "label", "model", F.round("score", R6).alias("score"))


def ranking(metrics: DataFrame) -> DataFrame:
    """O1: models by F1 descending within kind (model name breaks ties); a small window."""
    w = Window.partitionBy("kind").orderBy(F.desc("f1"), "model")
    return metrics.withColumn("rank", F.row_number().over(w))


def q_model_ranking(spark, sf_dir):
    m = M.model_metrics(all_scores(spark, sf_dir), ["kind", "model"])
    return cm._round_doubles(ranking(m).select("kind", "model", "f1", "roc_auc", "pr_auc", "rank"))


def q_top_models(spark, sf_dir):
    """O2: top-k rows per kind (the report's tables)."""
    m = M.threshold_metrics(all_scores(spark, sf_dir), ["kind", "model"])
    return cm._round_doubles(ranking(m).where(F.col("rank") <= TOP_K).select("kind", "model", "f1", "rank"))


def q_best_model(spark, sf_dir):
    """O3: per kind, the model with the best validation F1, reported with its test metrics."""
    s = all_scores(spark, sf_dir).join(txn_split(spark, sf_dir).select("row_id", "split"), "row_id")
    m = M.model_metrics(s.where(F.col("split").isin("val", "test")), ["split", "kind", "model"])
    val = m.where(F.col("split") == "val").groupBy("kind").agg(
        F.max_by("model", F.struct("f1", F.col("model"))).alias("model"), F.max("f1").alias("val_f1"))
    test = m.where(F.col("split") == "test").select("kind", "model", F.col("f1").alias("test_f1"),
                                                    F.col("roc_auc").alias("test_roc_auc"))
    return cm._round_doubles(val.join(test, ["kind", "model"]))


QUERIES = {
    "fit_logistic": q_fit_logistic,
    "fit_forest": q_fit_forest,
    "fit_boosted": q_fit_boosted,
    "fit_tree": q_fit_tree,
    "fit_svm_calibrated": q_fit_svm_calibrated,
    "linear_score": q_linear_score,
    "linear_models": q_linear_models,
    "compare_linear": q_compare_linear,
    "compare_models": q_compare_models,
    "central_baseline": q_central_baseline,
    "blend_scores": q_blend_scores,
    "model_ranking": q_model_ranking,
    "top_models": q_top_models,
    "best_model": q_best_model,
}

# ---------------------------------------------------------------------------------------------
# DuckDB oracle

_R = R6


def _blend_sql(src: str, blends=FIXTURE_BLENDS) -> str:
    members = sorted({m for a, b, _, _ in blends for m in (a, b)})
    cols = ", ".join(f"max(score) FILTER (WHERE model = '{m}') AS \"{m}\"" for m in members)
    parts = [f"SELECT row_id, label, '{ML.blend_name(a, b, wa, wb)}' AS model, "
             f"{float(wa)!r}::DOUBLE * \"{a}\" + {float(wb)!r}::DOUBLE * \"{b}\" AS score FROM wide"
             for a, b, wa, wb in blends]
    return (f", wide AS (SELECT row_id, label, {cols} FROM {src} GROUP BY row_id, label),\n"
            f"blends AS (SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE score IS NOT NULL),\n"
            f"allsc AS (SELECT *, 'single' AS kind FROM {src} UNION ALL SELECT *, 'hybrid' AS kind FROM blends)\n")


def _metrics_sql(src: str, keys: str) -> str:
    return f"""
, d AS (SELECT {keys}, score, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS pos,
               CAST(count(*) FILTER (WHERE label <> 1) AS DOUBLE) AS neg FROM {src} GROUP BY {keys}, score),
c AS (SELECT *, sum(pos) OVER (PARTITION BY {keys} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
              sum(neg) OVER (PARTITION BY {keys} ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
              sum(pos) OVER (PARTITION BY {keys}) AS n_pos, sum(neg) OVER (PARTITION BY {keys}) AS n_neg FROM d),
r AS (SELECT {keys},
  CASE WHEN max(n_pos) > 0 AND max(n_neg) > 0 THEN sum(neg * (tp - pos / 2.0)) / (max(n_pos) * max(n_neg)) END AS roc_auc,
  CASE WHEN max(n_pos) > 0 THEN sum(pos * tp / (tp + fp)) / max(n_pos) END AS pr_auc FROM c GROUP BY {keys}),
k AS (SELECT {keys},
   count(*) FILTER (WHERE score >= 0.5 AND label = 1) AS tp, count(*) FILTER (WHERE score >= 0.5 AND label <> 1) AS fp,
   count(*) FILTER (WHERE score < 0.5 AND label = 1) AS fn FROM {src} GROUP BY {keys}),
m AS (SELECT k.*, CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1, r.roc_auc, r.pr_auc
      FROM k JOIN r USING ({keys}))
"""


_S = fx.scores_cte()

ORACLE = {
    "blend_scores": _S + _blend_sql("scores") + f"SELECT row_id, label, model, round(score, {_R}) AS score FROM blends",
    "model_ranking": _S + _blend_sql("scores") + _metrics_sql("allsc", "kind, model") + f"""
SELECT kind, model, round(f1, {_R}) AS f1, round(roc_auc, {_R}) AS roc_auc, round(pr_auc, {_R}) AS pr_auc,
  CAST(row_number() OVER (PARTITION BY kind ORDER BY f1 DESC, model) AS INTEGER) AS rank FROM m""",
    "top_models": _S + _blend_sql("scores") + _metrics_sql("allsc", "kind, model") + f"""
SELECT * FROM (SELECT kind, model, round(f1, {_R}) AS f1,
  CAST(row_number() OVER (PARTITION BY kind ORDER BY f1 DESC, model) AS INTEGER) AS rank FROM m) WHERE rank <= {TOP_K}""",
    "best_model": with_ctes(TXN_MODEL_CTE, SPLIT_CTE) + f", kept AS ({fx.KEPT_SQL}), scores AS ({fx.SCORES_SQL})"
    + _blend_sql("scores") + ", sc AS (SELECT allsc.*, split.split FROM allsc JOIN split USING (row_id) "
    "WHERE split.split IN ('val', 'test'))" + _metrics_sql("sc", "split, kind, model") + f"""
, v AS (SELECT kind, model, f1 AS val_f1 FROM (
   SELECT *, row_number() OVER (PARTITION BY kind ORDER BY f1 DESC, model DESC) AS rk FROM m WHERE split = 'val') WHERE rk = 1)
SELECT v.kind, v.model, round(v.val_f1, {_R}) AS val_f1, round(t.f1, {_R}) AS test_f1, round(t.roc_auc, {_R}) AS test_roc_auc
FROM v JOIN m t ON t.kind = v.kind AND t.model = v.model AND t.split = 'test'""",
}

_LINEAR = fitted_catalog.VECTORS + f"""
, names AS ({fitted_catalog.NAMES}),
lin AS ({fx.linear_models_sql()}),
b AS (SELECT model, sum(coef) FILTER (WHERE feature = '(intercept)') AS b FROM lin GROUP BY model),
t AS (SELECT v.row_id, lin.model, sum(lin.coef * v.value) AS t FROM v JOIN names USING (pos) JOIN lin USING (feature) GROUP BY ALL),
scores AS (SELECT s.row_id, s.label, s.split, b.model, round(1 / (1 + exp(-(b.b + coalesce(t.t, 0)))), {_R}) AS score
           FROM split s JOIN b ON true LEFT JOIN t ON t.row_id = s.row_id AND t.model = b.model WHERE s.split IN ('val', 'test'))
"""
ORACLE["linear_models"] = _LINEAR + "SELECT row_id, label, split, " + ", ".join(
    f"max(score) FILTER (WHERE model = '{m}') AS {m}" for m in sorted({m for m, _, _ in fx.LINEAR_MODELS})) + " FROM scores GROUP BY row_id, label, split"
ORACLE["compare_linear"] = _LINEAR + """, plain AS (SELECT row_id, label, model, score FROM scores)
""" + _blend_sql("plain", fx.LINEAR_BLENDS) + """, sc AS (SELECT allsc.*, split.split FROM allsc JOIN split USING (row_id))
""" + _metrics_sql("sc", "split, kind, model").replace(
    "AS fn FROM", "AS fn, count(*) FILTER (WHERE score < 0.5 AND label <> 1) AS tn FROM") + f"""
, best AS (SELECT kind, model FROM m WHERE split = 'val' QUALIFY row_number() OVER (PARTITION BY kind ORDER BY f1 DESC, model DESC) = 1)
SELECT split, kind, model, tp + fp + fn + tn AS n, round((tp + tn) / (tp + fp + fn + tn), {_R}) AS accuracy,
  round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, {_R}) AS precision,
  round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, {_R}) AS recall, round(f1, {_R}) AS f1, round(roc_auc, {_R}) AS roc_auc, round(pr_auc, {_R}) AS pr_auc,
  CAST(row_number() OVER (PARTITION BY split, kind ORDER BY f1 DESC, model) AS INTEGER) AS rank,
  (kind, model) IN (SELECT (kind, model) FROM best) AS chosen, 0.5::DOUBLE AS threshold,
  (SELECT count(*) FROM split WHERE split = 'train') AS train_rows FROM m"""
