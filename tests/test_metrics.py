"""Hand-computed metric cases: ties, one class, thresholds, curves."""

import math

import pytest

from riskframe.operators import metrics as M


def _scores(spark, rows):
    return spark.createDataFrame([("m", y, s) for y, s in rows], "model string, label int, score double")


def _auc_brute(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    tot = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def _ap_brute(rows):
    P = sum(y for y, _ in rows)
    out = 0.0
    for t in sorted({s for _, s in rows}, reverse=True):
        sel = [(y, s) for y, s in rows if s >= t]
        tp = sum(y for y, _ in sel)
        pos_at = sum(y for y, s in rows if s == t)
        out += pos_at / P * tp / len(sel)
    return out


ROWS = [(1, 0.9), (0, 0.9), (1, 0.8), (0, 0.7), (0, 0.7), (1, 0.7), (0, 0.2), (1, 0.1), (0, 0.05), (0, 0.9)]


def test_auc_and_ap_with_ties(spark):
    r = M.ranking_metrics(_scores(spark, ROWS), ["model"]).first()
    assert r["roc_auc"] == pytest.approx(_auc_brute(ROWS), abs=1e-12)
    assert r["pr_auc"] == pytest.approx(_ap_brute(ROWS), abs=1e-12)


def test_curve_small_buckets_equal_brute(spark):
    import random

    rnd = random.Random(3)
    rows = [(int(rnd.random() < 0.3), round(rnd.random(), 2)) for _ in range(400)]
    df = _scores(spark, rows)
    curve = M.score_curve(df, ["model"], buckets=8)
    r = M.ranking_metrics_from_curve(curve, ["model"]).first()
    assert r["roc_auc"] == pytest.approx(_auc_brute(rows), abs=1e-12)
    assert r["pr_auc"] == pytest.approx(_ap_brute(rows), abs=1e-12)
    for c in curve.collect():
        assert c["tp"] == sum(y for y, s in rows if s >= c["score"])
        assert c["fp"] == sum(1 - y for y, s in rows if s >= c["score"])


def test_one_class_gives_null_auc(spark):
    r = M.ranking_metrics(_scores(spark, [(0, 0.1), (0, 0.4)]), ["model"]).first()
    assert r["roc_auc"] is None and r["pr_auc"] is None


def test_threshold_metrics_inclusive_and_zero_division(spark):
    t = M.threshold_metrics(_scores(spark, [(1, 0.5), (0, 0.49)]), ["model"]).first()
    assert t["precision"] == 1.0 and t["recall"] == 1.0 and t["f1"] == 1.0
    t = M.threshold_metrics(_scores(spark, [(0, 0.1), (1, 0.2)]), ["model"]).first()
    assert t["precision"] == 0.0 and t["f1"] == 0.0


def test_confusion_grid_has_four_cells(spark):
    c = M.confusion_matrix(_scores(spark, [(0, 0.1)]), ["model"]).collect()
    assert sorted((r["label"], r["pred"], r["n"]) for r in c) == [(0, 0, 1), (0, 1, 0), (1, 0, 0), (1, 1, 0)]


def test_log_loss_clips(spark):
    r = M.log_loss(_scores(spark, [(1, 1.0), (0, 0.0), (1, 0.5)]), ["model"]).first()
    assert r["log_loss"] == pytest.approx(math.log(2) / 3 + 2 * (-math.log(1 - M.FLOAT32_EPS)) / 3, rel=1e-6)


def test_pr_points_keep_every_threshold(spark):
    curve = M.score_curve(_scores(spark, ROWS), ["model"])
    pts = M.pr_points(curve, ["model"]).collect()
    assert max(p["recall"] for p in pts) == 1.0
    assert len(pts) == curve.count() + 1
    assert any(p["threshold"] is None and p["precision"] == 1.0 and p["recall"] == 0.0 for p in pts)


def test_points_of_one_class_group(spark):
    curve = M.score_curve(_scores(spark, [(0, 0.1), (0, 0.4)]), ["model"])
    assert [p["tpr"] for p in M.roc_points(curve, ["model"]).collect() if p["threshold"] is not None] == [None, None]
    assert [p["recall"] for p in M.pr_points(curve, ["model"]).collect() if p["threshold"] is not None] == [None, None]
