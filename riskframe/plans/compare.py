"""Model comparison plan (section 3.2): fit, score, blend, rank, report.

All fitted models score the val and test rows in one pass (chained projections to one wide row), blends are projections of
that row, and one stack feeds one grouped metric job.  Selection uses the validation split; the test split is reported.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import metrics as M
from riskframe.operators import models as ML
from riskframe.operators import report as RP
from riskframe.operators import scoring as SC
from riskframe.operators.split import training_sample
from riskframe.session import materialize
from riskframe.sources import sinks

MAX_TRAIN_SAMPLES = 60_000

# Result-table model labels (see ``models.BLENDS``) -> Spark ML fitters.
FITTERS = {
    "logistic_regression": ML.fit_logistic,
    "svm_linear_calibrated": ML.fit_svm_calibrated,
    "decision_tree": ML.fit_tree,
    "random_forest": ML.fit_forest,
    "xgboost": ML.fit_boosted,
}


@dataclass
class Comparison:
    scores: DataFrame    # long: row_id, label, split, kind, model, score
    metrics: DataFrame   # split, kind, model, n, accuracy, precision, recall, f1, roc_auc, pr_auc, rank, chosen, threshold, train_rows
    best: DataFrame      # per kind: chosen on val, reported on test
    report: DataFrame    # line_no, line


def run_comparison(vectors: DataFrame, out_dir: str | None = None, models: dict | None = None,
                   blends=ML.BLENDS, max_train_samples: int = MAX_TRAIN_SAMPLES, threshold: float = 0.5,
                   top_k: int = 5) -> Comparison:
    """``vectors(row_id, label, split, features)``; ``models`` maps a label to a fitter (all five unless given).  The metrics (a row per
    split and model) and the scores are stored in the checkpoint folder, so nothing stays cached."""
    fitters = models or FITTERS
    train = training_sample(vectors.where(F.col("split") == "train"), max_train_samples)
    fitted = ML.fit_together(train.sparkSession, {name: (lambda fit=fit: fit(train)) for name, fit in fitters.items()})
    rows = vectors.where(F.col("split").isin("val", "test"))
    keep = ("row_id", "label", "split")
    wide = materialize(SC.model_wide(fitted, rows, keep))
    scores = SC.stacked(wide, list(fitted), blends, keep)
    metrics = materialize(SC.comparison(scores, threshold, train.count()))
    test = metrics.where(F.col("split") == "test")
    best = test.where("chosen").drop("rank", "chosen", "split")
    results = test.drop("split", "rank", "chosen", "threshold", "train_rows")
    singles = results.where(F.col("kind") == "single").drop("kind")
    hybrids = results.where(F.col("kind") == "hybrid").drop("kind")
    report = RP.comparison_report(singles, hybrids, top_k, summary="ml_comparison_summary" if out_dir else None)
    if out_dir:
        out = out_dir.rstrip("/")
        hybrids_named = hybrids.withColumnRenamed("model", "hybrid_model")
        sinks.write_csv(RP.ranked(singles).drop("rank"), f"{out}/metrics/ml_single_results")
        sinks.write_csv(RP.ranked(hybrids).drop("rank").withColumnRenamed("model", "hybrid_model"), f"{out}/metrics/ml_hybrid_results")
        sinks.write_json(sinks.result_document(singles, threshold), f"{out}/metrics/ml_single_results_json")
        sinks.write_json(sinks.result_document(hybrids_named, threshold), f"{out}/metrics/ml_hybrid_results_json")
        sinks.write_json(summary(best), f"{out}/metrics/ml_comparison_summary")
        sinks.write_report(report, f"{out}/metrics/model_comparison_report")
    return Comparison(scores, metrics, best, report)


def summary(best: DataFrame) -> DataFrame:
    """One row with the best single model, the best blend, the threshold and the train rows used."""
    one = F.struct(*[c for c in best.columns if c not in ("kind", "threshold", "train_rows")])
    return best.agg(F.max(F.when(F.col("kind") == "single", one)).alias("best_single"), F.max(F.when(F.col("kind") == "hybrid", one)).alias("best_hybrid"),
                    F.max("threshold").alias("threshold"), F.max("train_rows").alias("train_samples_used"))


def central_baseline(vectors: DataFrame, out_dir: str | None = None, threshold: float = 0.5) -> DataFrame:
    """The central baseline: a balanced logistic regression on all train rows, judged on the test rows.

    ``(part, item, x, y, value)``: ``metric`` (by name; loss attached, S12), ``report`` (per class and average, ``item`` ``class:figure``), ``confusion``
    (x label, y predicted, value rows), ``roc`` (x fpr, y tpr, value threshold) and ``pr`` (x recall, y precision, value threshold).
    All parts come from one stored score table.
    """
    model = ML.fit_logistic(vectors.where(F.col("split") == "train"))
    scores = materialize(ML.positive_scores(model, vectors.where(F.col("split") == "test"), "logreg_balanced"))
    loss = M.log_loss(scores).first()
    metrics = sinks.with_loss(M.model_metrics(scores, ["model"], threshold), loss["log_loss"] if loss else float("nan"))
    metrics = materialize(metrics)
    report = M.class_report(scores, ["model"], threshold)
    curve = M.score_curve(scores, ["model"])
    none = F.lit(None).cast("double")
    row = lambda df, part, item, x, y, value: df.select(F.lit(part).alias("part"), item.alias("item"), x.cast("double").alias("x"),
                                                        y.cast("double").alias("y"), value.cast("double").alias("value"))
    long = lambda df, names: df.select("*", F.inline(F.array(*[F.struct(F.lit(c).alias("_item"), F.col(c).cast("double").alias("_v")) for c in names])))
    figures = ["precision", "recall", "f1", "support"]
    if out_dir:
        out = out_dir.rstrip("/")
        sinks.write_csv(metrics, f"{out}/metrics/centralized_results")
        sinks.write_json(metrics, f"{out}/metrics/centralized_metrics")
        sinks.write_json(report, f"{out}/metrics/centralized_classification_report")
    empty = F.lit("")
    return (row(long(metrics, [c for c in metrics.columns if c != "model"]), "metric", F.col("_item"), none, none, F.col("_v"))
            .unionByName(row(long(report, figures), "report", F.concat_ws(":", "class_name", "_item"), none, none, F.col("_v")))
            .unionByName(row(M.confusion_matrix(scores, ["model"], threshold), "confusion", empty, F.col("label"), F.col("pred"), F.col("n")))
            .unionByName(row(M.roc_points(curve, ["model"]), "roc", empty, F.col("fpr"), F.col("tpr"), F.col("threshold")))
            .unionByName(row(M.pr_points(curve, ["model"]), "pr", empty, F.col("recall"), F.col("precision"), F.col("threshold"))))
