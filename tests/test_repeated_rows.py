"""Rows equal in every column, NULL groups and text that no time rule parses."""

import math

import pytest

from riskframe.operators import metrics as M
from riskframe.operators import models as ML
from riskframe.operators.roles import resolve_event_time


def test_equal_rows_keep_a_blend_each(spark):
    rows = [(1, 0, "a", 0.2), (1, 0, "a", 0.2), (1, 0, "b", 0.6), (1, 0, "b", 0.6), (2, 1, "a", 0.5), (2, 1, "b", None), (None, 1, "a", 1.0), (None, 1, "b", 0.0)]
    s = spark.createDataFrame(rows, "row_id long, label int, model string, score double")
    out = ML.blend_scores(s, [("a", "b", 0.5, 0.5)]).collect()
    got = sorted((r["row_id"] or 0, r["score"] if r["score"] is None else round(r["score"], 9)) for r in out)
    assert got == [(0, 0.5), (1, 0.4), (1, 0.4), (2, None)]


def test_equal_rows_score_alike(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,)], "row_id long")
    long = spark.createDataFrame([(1, 0, 0.5), (1, 0, 0.5)], "row_id long, pos int, value double")
    coefs = spark.createDataFrame([(0, 0.6)], "pos int, coef double")
    got = sorted(r["score"] for r in ML.linear_scores(rows, long, coefs, 0.0).collect())
    assert got == pytest.approx([0.5, 1 / (1 + math.exp(-0.3)), 1 / (1 + math.exp(-0.3))])


def test_null_group_keeps_its_curve(spark):
    rows = [(g, y, s) for g in ("m", None) for y, s in [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.1)]]
    s = spark.createDataFrame(rows, "model string, label int, score double")
    got = {r["model"]: (r["roc_auc"], r["pr_auc"]) for r in M.ranking_metrics(s).collect()}
    assert set(got) == {"m", None} and got["m"] == got[None] and got["m"][0] == 0.75
    assert M.balanced_weights(s, by=["model"]).where("model is null and weight = 1.0").count() == 4


def test_text_that_is_no_time_raises(spark):
    df = spark.createDataFrame([("soon", "later")], "event_date string, event_time string")
    with pytest.raises(ValueError):
        resolve_event_time(df)
