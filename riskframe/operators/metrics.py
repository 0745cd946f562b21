"""Imbalance-aware metrics as distributed aggregations.

Scores arrive long: one row per (group..., row) with a 0/1 label and a score; ``by`` names the group
columns (a model name, a client, a round).  Every metric of every group comes out of one job.

Score curves (W1) need cumulative counts by descending score.  A plain window over all scores is one
task; instead scores are first collapsed to distinct values, cut into order-preserving buckets at
approximate quantiles of the distinct scores (so a hot score value cannot make a bucket large), and
cumulated in two levels: bucket offsets over a small table, then a window inside each bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.rank import count_below, join_groups

CURVE_BUCKETS = 1024
CURVE_ACCURACY = 20_000
BROADCAST_ROWS = 2_000_000
FLOAT32_EPS = 1.1920928955078125e-07  # log loss clip of float32 scores
BCE_LOG_FLOOR = -100.0


def _safe_div(num: Column, den: Column) -> Column:
    """``num / den``, 0 when the denominator is 0 (the ``zero_division=0`` rule)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


# ---------------------------------------------------------------------------------------------
# Class balance (A1-A4)


def class_ratio(df: DataFrame, by: Sequence[str] = ("split",), label: str = "label") -> DataFrame:
    """A1: rows, positives and positive share per group."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(label) == 1).alias("fraud_count"),
        F.avg((F.col(label) == 1).cast("double")).alias("fraud_ratio"),
    )


def class_weight_ratio_col(label: Column) -> Column:
    """A2 as an aggregate: negatives / max(positives, 1)."""
    return F.count_if(label == 0) / F.greatest(F.count_if(label == 1), F.lit(1))


def client_balance(df: DataFrame, by: Sequence[str] = ("client_id",), label: str = "label") -> DataFrame:
    """A3: per client rows, positive share and ``pos_weight`` (A2)."""
    y = F.col(label)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((y == 1).cast("double")).alias("fraud_ratio"),
        class_weight_ratio_col(y).alias("pos_weight"),
    )


def balanced_weights(df: DataFrame, label: str = "label", by: Sequence[str] = (), out: str = "weight") -> DataFrame:
    """A4: ``weight = n / (n_classes * n_class)`` attached to each row (class counts, 2 rows per group; broadcast where counted few)."""
    by = list(by)
    counts = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("_nc"))
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    counts = counts.select(
        *by, label,
        (F.sum("_nc").over(w) / (F.count(F.lit(1)).over(w) * F.col("_nc"))).alias(out),
    )
    # Without groups there is one row per class.
    few = not by or counts.count() <= BROADCAST_ROWS
    return join_groups(df, counts, [*by, label], few=few)


# ---------------------------------------------------------------------------------------------
# Threshold metrics


def confusion_counts(scores: DataFrame, by: Sequence[str] = ("model",), threshold: float = 0.5,
                     score: str = "score", label: str = "label") -> DataFrame:
    """tp, fp, fn, tn per group with ``pred = score >= threshold`` (one aggregation)."""
    pred = F.col(score) >= F.lit(float(threshold))
    y = F.col(label) == 1
    return scores.groupBy(*by).agg(
        F.count_if(pred & y).alias("tp"),
        F.count_if(pred & ~y).alias("fp"),
        F.count_if(~pred & y).alias("fn"),
        F.count_if(~pred & ~y).alias("tn"),
    )


def confusion_matrix(scores: DataFrame, by: Sequence[str] = ("model",), threshold: float = 0.5,
                     score: str = "score", label: str = "label") -> DataFrame:
    """The fixed 2x2 grid in long form ``(by..., label, pred, n)``; absent cells are 0."""
    c = confusion_counts(scores, by, threshold, score, label)
    return c.select(*by, F.expr("stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (label, pred, n)"))


def threshold_metrics_from_counts(c: DataFrame, by: Sequence[str]) -> DataFrame:
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    precision = _safe_div(tp, tp + fp)
    recall = _safe_div(tp, tp + fn)
    return c.select(
        *by,
        (tp + fp + fn + tn).alias("n"),
        _safe_div(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def threshold_metrics(scores: DataFrame, by: Sequence[str] = ("model",), threshold: float = 0.5,
                      score: str = "score", label: str = "label") -> DataFrame:
    """Accuracy, precision, recall, F1 (0 when undefined) per group."""
    return threshold_metrics_from_counts(confusion_counts(scores, by, threshold, score, label), list(by))


def class_report(scores: DataFrame, by: Sequence[str] = ("model",), threshold: float = 0.5,
                 score: str = "score", label: str = "label") -> DataFrame:
    """Per-class precision / recall / F1 / support, accuracy, macro and weighted averages (long)."""
    by = list(by)
    c = confusion_counts(scores, by, threshold, score, label)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    p1, r1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    p0, r0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    f1_1, f1_0 = _safe_div(2 * tp, 2 * tp + fp + fn), _safe_div(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    acc = _safe_div(tp + tn, n)

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class_name"), p.cast("double").alias("precision"),
                        r.cast("double").alias("recall"), f.cast("double").alias("f1"),
                        s.cast("bigint").alias("support"))

    rows = F.array(
        row("0", p0, r0, f1_0, s0),
        row("1", p1, r1, f1_1, s1),
        row("accuracy", F.lit(None), F.lit(None), acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, n),
        row("weighted avg", _safe_div(p0 * s0 + p1 * s1, n), _safe_div(r0 * s0 + r1 * s1, n),
            _safe_div(f1_0 * s0 + f1_1 * s1, n), n),
    )
    return c.select(*by, F.inline(rows))


# ---------------------------------------------------------------------------------------------
# Score curves (W1) and ranking metrics


def score_curve(scores: DataFrame, by: Sequence[str] = ("model",), score: str = "score",
                label: str = "label", buckets: int = CURVE_BUCKETS) -> DataFrame:
    """One row per (group, distinct score) with ``pos``, ``neg`` at that score and cumulative
    ``tp``, ``fp`` over scores >= it, plus group totals ``P``-as-``n_pos`` and ``n_neg``."""
    by = list(by)
    y = F.col(label)
    # Read three times below (cut points, bucket totals, the final pass): keep the aggregate.
    distinct = scores.groupBy(*by, score).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y != 1).alias("neg")).persist()

    probs = [i / buckets for i in range(1, buckets)]
    cuts = distinct.groupBy(*by).agg(
        F.percentile_approx(score, probs, CURVE_ACCURACY).alias("_cuts"))
    cuts = cuts.persist()
    n_groups = cuts.count()
    steps = max(1, (buckets - 1).bit_length()) + 1
    if n_groups == 1:
        # One group: the 1,023 cut points become a literal array (no join at all).
        arr = cuts.first()["_cuts"] or []
        lit_cuts = F.array(*[F.lit(float(v)) for v in arr]).cast("array<double>")
        bucketed = distinct.withColumn("_b", count_below(lit_cuts, F.col(score).cast("double"), steps))
    else:
        bucketed = join_groups(distinct, cuts, by, few=n_groups * buckets <= BROADCAST_ROWS) \
            .withColumn("_b", count_below(F.col("_cuts"), F.col(score), steps)).drop("_cuts")

    totals = bucketed.groupBy(*by, "_b").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"))
    above = Window.partitionBy(*by).orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    offsets = totals.select(
        *by, "_b",
        F.coalesce(F.sum("_bp").over(above), F.lit(0)).alias("_op"),
        F.coalesce(F.sum("_bn").over(above), F.lit(0)).alias("_on"),
        F.sum("_bp").over(whole).alias("n_pos"),
        F.sum("_bn").over(whole).alias("n_neg"),
    )
    n_off = offsets.persist().count()
    inside = Window.partitionBy(*by, "_b").orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    joined = join_groups(bucketed, offsets, [*by, "_b"], few=n_off <= BROADCAST_ROWS)
    return joined.select(
        *by, score, "pos", "neg",
        (F.sum("pos").over(inside) + F.col("_op")).cast("bigint").alias("tp"),
        (F.sum("neg").over(inside) + F.col("_on")).cast("bigint").alias("fp"),
        F.col("n_pos").cast("bigint").alias("n_pos"),
        F.col("n_neg").cast("bigint").alias("n_neg"),
    )


def ranking_metrics_from_curve(curve: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """A9 ROC-AUC (ties averaged) and A10 step average precision; NULL for a one-class group."""
    tp, pos, neg, fp = F.col("tp"), F.col("pos"), F.col("neg"), F.col("fp")
    P, N = F.col("n_pos"), F.col("n_neg")
    auc_term = neg.cast("double") * (tp - pos / 2.0)
    ap_term = pos.cast("double") * tp / (tp + fp)
    g = curve.groupBy(*by).agg(
        F.sum(auc_term).alias("_auc"), F.sum(ap_term).alias("_ap"),
        F.first(P).alias("_P"), F.first(N).alias("_N"))
    return g.select(
        *by,
        F.when((F.col("_P") > 0) & (F.col("_N") > 0), F.col("_auc") / (F.col("_P") * F.col("_N"))).alias("roc_auc"),
        F.when(F.col("_P") > 0, F.col("_ap") / F.col("_P")).alias("pr_auc"),
    )


def ranking_metrics(scores: DataFrame, by: Sequence[str] = ("model",), score: str = "score", label: str = "label") -> DataFrame:
    return ranking_metrics_from_curve(score_curve(scores, by, score, label), by)


def model_metrics(scores: DataFrame, by: Sequence[str] = ("model",), threshold: float = 0.5,
                  score: str = "score", label: str = "label") -> DataFrame:
    """A8 + A9 + A10: accuracy, precision, recall, F1, ROC-AUC, PR-AUC per group.

    One aggregation over the score curve's distinct-score rows: the confusion counts at the threshold
    are sums of ``pos`` / ``neg`` over scores >= threshold, so no second pass and no join is needed.
    """
    by = list(by)
    keys = by or ["_all"]
    if not by:
        scores = scores.withColumn("_all", F.lit(0))
    c = score_curve(scores, keys, score, label)
    above = F.col(score) >= F.lit(float(threshold))
    tp, pos, neg, fp = F.col("tp"), F.col("pos"), F.col("neg"), F.col("fp")
    g = c.groupBy(*keys).agg(
        F.sum(F.when(above, pos).otherwise(0)).alias("tp"),
        F.sum(F.when(above, neg).otherwise(0)).alias("fp"),
        F.first("n_pos").alias("_P"), F.first("n_neg").alias("_N"),
        F.sum(neg.cast("double") * (tp - pos / 2.0)).alias("_auc"),
        F.sum(pos.cast("double") * tp / (tp + fp)).alias("_ap"))
    P, N = F.col("_P"), F.col("_N")
    counts = g.select(*keys, "tp", "fp", (P - F.col("tp")).alias("fn"), (N - F.col("fp")).alias("tn"), "_P", "_N",
                      "_auc", "_ap")
    out = threshold_metrics_from_counts(counts, keys + ["_P", "_N", "_auc", "_ap"]).select(
        *keys, "n", "accuracy", "precision", "recall", "f1",
        F.when((P > 0) & (N > 0), F.col("_auc") / (P * N)).alias("roc_auc"),
        F.when(P > 0, F.col("_ap") / P).alias("pr_auc"))
    return out if by else out.drop("_all")


def roc_points(curve: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """(fpr, tpr, threshold) at every distinct score, plus the origin with a NULL threshold.

    A rate whose class is missing from a group is NULL.
    """
    by = list(by)
    pts = curve.select(*by, F.try_divide("fp", "n_neg").alias("fpr"),
                       F.try_divide("tp", "n_pos").alias("tpr"),
                       F.col("score").cast("double").alias("threshold"))
    origin = curve.select(*by).distinct().select(*by, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
                                                 F.lit(None).cast("double").alias("threshold"))
    return pts.unionByName(origin)


def pr_points(curve: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """(precision, recall, threshold) at every distinct score, plus the (1, 0) end point.

    The recall of a group without positives is NULL.
    """
    by = list(by)
    tp, fp = F.col("tp"), F.col("fp")
    pts = curve.select(
        *by, (tp / (tp + fp)).alias("precision"), F.try_divide("tp", "n_pos").alias("recall"),
        F.col("score").cast("double").alias("threshold"))
    end = curve.select(*by).distinct().select(*by, F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
                                              F.lit(None).cast("double").alias("threshold"))
    return pts.unionByName(end)


# ---------------------------------------------------------------------------------------------
# Losses (A14, A15)


def log_loss(scores: DataFrame, by: Sequence[str] = ("model",), score: str = "score", label: str = "label",
             eps: float = FLOAT32_EPS) -> DataFrame:
    """Mean cross entropy with scores clipped to [eps, 1 - eps]."""
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    y = F.col(label).cast("double")
    term = -(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))
    return scores.groupBy(*by).agg(F.avg(term).alias("log_loss"))


def bce_loss(scores: DataFrame, by: Sequence[str] = ("client_id",), score: str = "score", label: str = "label") -> DataFrame:
    """Unweighted binary cross entropy on probabilities, each log clamped at -100."""
    p = F.col(score).cast("double")
    y = F.col(label).cast("double")
    ln_p = F.greatest(F.coalesce(F.log(p), F.lit(BCE_LOG_FLOOR)), F.lit(BCE_LOG_FLOOR))
    ln_q = F.greatest(F.coalesce(F.log(F.lit(1.0) - p), F.lit(BCE_LOG_FLOOR)), F.lit(BCE_LOG_FLOOR))
    return scores.groupBy(*by).agg(F.avg(-(y * ln_p + (F.lit(1.0) - y) * ln_q)).alias("bce_loss"))
