"""Several models over the same rows (M6-M8, O1, O3): one wide row of scores per input row, no join and no union.

Fitted models are chained projections over the feature vector; linear models given as a coefficient table are
scored inside the row, the category part through the same dictionary join that encodes the row.  Blends are projections of the
wide row, and one ``stack`` turns it into the long table of the metric job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators import metrics as M
from riskframe.operators.models import BLENDS, CalibratedSVM, blend_name, sigmoid
from riskframe.operators.prep import NUM_PREFIX, FittedPrep

INTERCEPT = "(intercept)"


def linear_wide(prep: FittedPrep, rows: DataFrame, coefficients: DataFrame, keep: Sequence[str] = ("row_id", "label")) -> DataFrame:
    """M8: ``(keep..., <model>...)``, sigmoid(x . w + b) of each row under each model of ``coefficients(model, feature, coef)``.

    Features are named as ``FittedPrep.names`` names them, the constant ``(intercept)``; names it does not know have no effect, absent ones a
    coefficient of 0.  The numbers of numeric columns (models x columns) become literals; those of categories join the
    dictionary once, as an array per category.  Every input row keeps its own score, whatever its key.
    """
    models = sorted(r["model"] for r in coefficients.select("model").distinct().collect())
    plain = [INTERCEPT, *(NUM_PREFIX + c for c in prep.numeric)]
    own = {(r["model"], r["feature"]): r["coef"] for r in coefficients.where(F.col("feature").isin(plain)).collect()}
    d = prep.impute_scale(rows)
    if prep.categorical:
        per_pos = (prep.names().join(coefficients, "feature").groupBy("pos").pivot("model", models).agg(F.first("coef"))
                   .select("pos", F.array(*[F.coalesce(F.col(f"`{m}`"), F.lit(0.0)) for m in models]).alias("v")))
        at = prep.dictionary.withColumn("pos", (F.col("idx") + len(prep.numeric)).cast("int"))
        d = prep.with_dictionary(d, at.join(per_pos, "pos").select("cpos", "category", "v"), prefix="_w_")
    scores = []
    for k, m in enumerate(models):
        z = F.lit(float(own.get((m, INTERCEPT), 0.0)))
        for c in prep.numeric:
            if own.get((m, NUM_PREFIX + c)):
                z = z + F.lit(float(own[m, NUM_PREFIX + c])) * F.col(f"_n_{c}")
        for c in prep.categorical:
            z = z + F.coalesce(F.get(f"_w_{c}", F.lit(k)), F.lit(0.0))
        scores.append(sigmoid(z).alias(m))
    return d.select(*keep, *scores)


def _positive(d: DataFrame, model, k: int, features: str) -> tuple[DataFrame, Column]:
    """``d`` with what ``model`` adds under names of its own, and the positive-class score."""
    if isinstance(model, CalibratedSVM):
        parts = []
        for j, (svm, platt) in enumerate(model.pairs):
            raw = f"_raw{k}_{j}"
            d = svm.copy({svm.rawPredictionCol: raw, svm.predictionCol: f"_pred{k}_{j}"}).transform(d)
            parts.append(sigmoid(F.lit(float(platt.coefficients[0])) * vector_to_array(raw)[1] + F.lit(float(platt.intercept))))
        return d, sum(parts[1:], parts[0]) / F.lit(float(len(parts)))
    if not hasattr(model, "rawPredictionCol"):  # a model of our own
        return model.add_score(d, f"_own{k}", features), F.col(f"_own{k}")
    raw, prob = f"_raw{k}", f"_prob{k}"
    named = {model.rawPredictionCol: raw, model.predictionCol: f"_pred{k}"}
    if model.hasParam("probabilityCol"):
        named[model.probabilityCol] = prob
    d = model.copy(named).transform(d)
    return d, vector_to_array(prob)[1] if prob in d.columns else sigmoid(vector_to_array(raw)[1])


def model_wide(models: Mapping[str, object], rows: DataFrame, keep: Sequence[str] = ("row_id", "label"), features: str = "features") -> DataFrame:
    """M6: ``(keep..., <model>...)``, the positive-class score of every fitted model, in one pass over ``rows``."""
    d, scores = rows.select(*keep, features), []
    for k, (name, model) in enumerate(models.items()):
        d, score = _positive(d, model, k, features)
        scores.append(score.alias(name))
    return d.select(*keep, *scores)


def stacked(wide: DataFrame, models: Sequence[str], blends=BLENDS, keep: Sequence[str] = ("row_id", "label")) -> DataFrame:
    """M7 + J1: ``(keep..., kind, model, score)`` of a wide row: its models, and its blends ``wa * a + wb * b`` where both
    members are there.  A NULL member score gives a NULL blend."""
    cell = lambda kind, name, score: F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("model"), score.alias("score"))
    cells = [cell("single", m, F.col(f"`{m}`")) for m in models]
    cells += [cell("hybrid", blend_name(a, b, wa, wb), F.lit(float(wa)) * F.col(f"`{a}`") + F.lit(float(wb)) * F.col(f"`{b}`"))
              for a, b, wa, wb in blends if a in models and b in models]
    return wide.select(*keep, F.inline(F.array(*cells)))


def comparison(scores: DataFrame, threshold: float = 0.5, train_rows: int = 0) -> DataFrame:
    """O1 + O3: metrics of ``scores(split, kind, model, label, score)`` per (split, kind, model), ranked by F1 within split and kind, with the
    threshold and the number of train rows used.  ``chosen`` marks, in every split, the model of best F1 on ``val``
    (the greater name on ties).  One metric job; what follows it works on its few rows."""
    m = M.model_metrics(scores, ["split", "kind", "model"], threshold)
    best = F.max(F.when(F.col("split") == "val", F.struct("f1", "model"))).over(Window.partitionBy("kind"))
    rank = F.row_number().over(Window.partitionBy("split", "kind").orderBy(F.desc("f1"), "model"))
    return (m.withColumn("rank", rank).withColumn("chosen", F.coalesce(best["model"] == F.col("model"), F.lit(False)))
            .withColumn("threshold", F.lit(float(threshold))).withColumn("train_rows", F.lit(int(train_rows)).cast("long")))
