"""Class-weighted classifiers, positive-class scores and weighted blends.

Estimators are Spark ML's, fitted on a feature-vector column with a per-row weight column.  Scores
come back as one row per input row, so several models' scores sit side by side without a join.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.hashing import order_hash
from riskframe.operators.metrics import BROADCAST_ROWS, balanced_weights, join_groups
from riskframe.operators.rank import assign_by_rank, intervals_from_sizes, ntile_sizes
from riskframe.operators.split import TRAIN_PART_ROWS
from riskframe.session import materialize

SEED = 42

# The reference's estimator settings.
LOGISTIC = {"maxIter": 400}
LOGISTIC_TOL = 1e-4
FOREST = {"numTrees": 300, "maxDepth": 14, "minInstancesPerNode": 8}
BOOSTED = {"maxIter": 300, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.9, "featureSubsetStrategy": "0.9"}
TREE = {"maxDepth": 12, "minInstancesPerNode": 20}
CALIBRATION_FOLDS = 3
# Result-table model labels and weighted blends (model a, model b, weight a, weight b) as the
# reference names them, so result rows keep their names; the "xgboost" label is served by Spark's GBT.
BLENDS = (("xgboost", "logistic_regression", 0.7, 0.3), ("xgboost", "random_forest", 0.6, 0.4))


def sigmoid(z: Column) -> Column:
    """X6."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def with_class_weights(train: DataFrame, label: str = "label", mode: str = "balanced") -> DataFrame:
    """A4 ``balanced`` (n / 2 n_class) or A2 ``pos_ratio`` (positives weighted negatives / positives)."""
    if mode == "balanced":
        return balanced_weights(train, label, out="weight")
    if mode == "pos_ratio":
        ratio = train.agg((F.count_if(F.col(label) == 0) / F.greatest(F.count_if(F.col(label) == 1), F.lit(1)))
                          .alias("_r")).first()["_r"]
        return train.withColumn("weight", F.when(F.col(label) == 1, F.lit(float(ratio))).otherwise(F.lit(1.0)))
    raise ValueError("mode must be 'balanced' or 'pos_ratio'")


def fit_logistic(train: DataFrame, features: str = "features", label: str = "label", max_iter: int = 400):
    """M1: balanced weights; C = 1 in the summed-loss objective is ``regParam = 1 / sum(weights) = 1 / n``."""
    w = with_class_weights(train, label)
    n = train.count()
    lr = LogisticRegression(featuresCol=features, labelCol=label, weightCol="weight", maxIter=max_iter,
                            regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False, tol=LOGISTIC_TOL)
    return lr.fit(w.withColumn(label, F.col(label).cast("double")))


def fit_forest(train: DataFrame, features: str = "features", label: str = "label", **params):
    """M2 (balanced weights stand in for per-bootstrap balancing, A5)."""
    p = {**FOREST, **params}
    w = with_class_weights(train, label)
    rf = RandomForestClassifier(featuresCol=features, labelCol=label, weightCol="weight", seed=SEED,
                                featureSubsetStrategy="sqrt", **p)
    return rf.fit(w.withColumn(label, F.col(label).cast("double")))


def fit_boosted(train: DataFrame, features: str = "features", label: str = "label", **params):
    """M3: gradient-boosted trees, positives weighted by negatives / positives."""
    p = {**BOOSTED, **params}
    w = with_class_weights(train, label, "pos_ratio")
    gbt = GBTClassifier(featuresCol=features, labelCol=label, weightCol="weight", seed=SEED, **p)
    return gbt.fit(w.withColumn(label, F.col(label).cast("double")))


def fit_tree(train: DataFrame, features: str = "features", label: str = "label", **params):
    """M5."""
    p = {**TREE, **params}
    w = with_class_weights(train, label)
    dt = DecisionTreeClassifier(featuresCol=features, labelCol=label, weightCol="weight", seed=SEED, **p)
    return dt.fit(w.withColumn(label, F.col(label).cast("double")))


def fit_together(spark: SparkSession, fits: Mapping[str, Callable[[], object]]) -> dict[str, object]:
    """What each of the independent ``fits`` returns.  Fits make many short jobs that leave most cores idle, so they run side by side in threads of
    the driver, as Spark's cross validation runs its folds."""
    if not fits:
        return {}
    with ThreadPool(len(fits)) as pool:
        return dict(zip(fits, pool.map(lambda f: f(), [inheritable_thread_target(spark)(f) for f in fits.values()], chunksize=1)))


class CalibratedSVM:
    """M4: linear SVM per fold, sigmoid-calibrated on the held-out fold; probabilities averaged."""

    def __init__(self, pairs):
        self.pairs = pairs  # [(LinearSVCModel, LogisticRegressionModel on the margin)]


def calibration_folds(train: DataFrame, label: str = "label", row_id: str = "row_id", folds: int = CALIBRATION_FOLDS) -> DataFrame:
    """``train`` with ``_fold`` 0 .. folds - 1: each class in a seeded order, cut into near-equal parts, so that every fold holds
    every class of ``folds`` rows or more, its share exact to one row."""

    def segments(totals: DataFrame) -> DataFrame:
        return intervals_from_sizes(totals, [label], ntile_sizes(F.col("n"), folds), F.array(*[F.lit(k) for k in range(folds)]), "_fold")

    return assign_by_rank(train.withColumn("_fh", order_hash(row_id, SEED, "fold")), hash_col="_fh", tiebreak=row_id, segments=segments, strata=[label]).drop("_fh")


def fit_svm_calibrated(train: DataFrame, features: str = "features", label: str = "label",
                       row_id: str = "row_id", folds: int = CALIBRATION_FOLDS) -> CalibratedSVM:
    """Weights and C = 1 (``regParam = 1 / sum(weights)``) are those of the rows that a fold fits on.

    The solver passes over its rows hundreds of times, so the dealt rows are stored once, in as many partitions as they fill, and the folds are
    fitted side by side."""
    dealt = materialize(calibration_folds(train, label, row_id, folds))
    dealt = materialize(dealt.repartition(max(1, -(-dealt.count() // TRAIN_PART_ROWS)), row_id).sortWithinPartitions(row_id))

    def fold(k: int) -> tuple:
        fit_part = with_class_weights(dealt.where(F.col("_fold") != k), label).withColumn(label, F.col(label).cast("double"))
        cal_part = dealt.where(F.col("_fold") == k).withColumn(label, F.col(label).cast("double"))
        total = fit_part.agg(F.sum("weight").alias("w")).first()["w"]
        svm = LinearSVC(featuresCol=features, labelCol=label, weightCol="weight", regParam=1.0 / (total or 1.0),
                        maxIter=100, standardization=False).fit(fit_part)
        margin = svm.transform(cal_part).withColumn("_m", vector_to_array("rawPrediction")[1])
        margin = VectorAssembler(inputCols=["_m"], outputCol="_mv").transform(margin)
        platt = LogisticRegression(featuresCol="_mv", labelCol=label, maxIter=100, predictionCol="_pp",
                                   rawPredictionCol="_pr", probabilityCol="_pb").fit(margin)
        return svm, platt

    pairs = fit_together(train.sparkSession, {str(k): (lambda k=k: fold(k)) for k in range(folds)})
    return CalibratedSVM(list(pairs.values()))


def positive_scores(model, df: DataFrame, name: str, features: str = "features",
                    keep: Sequence[str] = ("row_id", "label")) -> DataFrame:
    """M6: positive-class probability, else sigmoid of the margin: ``(keep..., model, score)``."""
    keep = list(keep)
    if isinstance(model, CalibratedSVM):
        d = df.select(*keep, features)
        probs = []
        for i, (svm, platt) in enumerate(model.pairs):
            d = svm.setRawPredictionCol(f"_raw{i}").setPredictionCol(f"_pred{i}").transform(d)
            m = vector_to_array(f"_raw{i}")[1]
            a = float(platt.coefficients[0])
            probs.append(sigmoid(F.lit(a) * m + F.lit(float(platt.intercept))))
        score = sum(probs[1:], probs[0]) / F.lit(float(len(probs)))
        return d.select(*keep, F.lit(name).alias("model"), score.alias("score"))
    out = model.transform(df.select(*keep, features))
    if "probability" in out.columns:
        score = vector_to_array("probability")[1]
    else:
        score = sigmoid(vector_to_array("rawPrediction")[1])
    return out.select(*keep, F.lit(name).alias("model"), score.alias("score"))


def blend_name(a: str, b: str, wa: float, wb: float) -> str:
    """``a+b_w70_30``; percentages floored after a tiny lift so that 0.29 reads 29, not 28."""
    return f"{a}+{b}_w{int(wa * 100 + 1e-9)}_{int(wb * 100 + 1e-9)}"


def blend_scores(scores: DataFrame, blends=BLENDS, keys: Sequence[str] = ("row_id", "label")) -> DataFrame:
    """M7 + J1 on a long score table: each row's member scores side by side (one shuffle on the row
    key), then ``wa * a + wb * b``.  A blend with a missing member model is skipped.

    Rows that repeat a key (rows equal in every column, without a key column) keep a row each: the blend has the rows of its first
    member, each with the mean score that its key has from either model.  A NULL or missing member score gives a NULL blend.
    """
    keys = list(keys)
    present = {r["model"] for r in scores.select("model").distinct().collect()}
    todo = [(a, b, wa, wb) for a, b, wa, wb in blends if a in present and b in present]
    if not todo:
        return scores.limit(0)
    members = sorted({m for a, b, _, _ in todo for m in (a, b)})
    wide = scores.where(F.col("model").isin(members)).groupBy(*keys).pivot("model", members).agg(F.avg("score"))
    base = scores.where(F.col("model").isin([a for a, _, _, _ in todo])).select(*keys, F.col("model").alias("_first"))
    blended = F.array(*[F.struct(F.lit(a).alias("first"), F.lit(blend_name(a, b, wa, wb)).alias("model"),
                                 (F.lit(float(wa)) * F.col(f"`{a}`") + F.lit(float(wb)) * F.col(f"`{b}`")).alias("score"))
                        for a, b, wa, wb in todo])
    rows = join_groups(base, wide, keys, few=False).withColumn("_blends", F.filter(blended, lambda x: x["first"] == F.col("_first")))
    return rows.select(*keys, F.inline("_blends")).drop("first")


def linear_scores(rows: DataFrame, features_long: DataFrame, coefficients: DataFrame, intercept: float,
                  keys: Sequence[str] = ("row_id",)) -> DataFrame:
    """M8: score ``rows`` whose features are given long as ``(keys..., pos, value)`` with a coefficient
    table ``(pos, coef)`` (one row per feature, broadcast where counted few) -> ``(keys..., score)`` = sigmoid(x . w + b).
    Rows without non-zero features score sigmoid(b); equal rows under one key keep a row each, their sum shared by their number."""
    keys = list(keys)
    few = coefficients.count() <= BROADCAST_ROWS
    z = (features_long.join(F.broadcast(coefficients) if few else coefficients, "pos")
         .groupBy(*keys).agg(F.sum(F.col("value") * F.col("coef")).alias("_z")))
    same = join_groups(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_same")), z, keys, few=False, how="left")
    out = join_groups(rows.select(*keys), same, keys, few=False)
    return out.select(*keys, sigmoid(F.coalesce(F.col("_z") / F.col("_same"), F.lit(0.0)) + F.lit(float(intercept))).alias("score"))
