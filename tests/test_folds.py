"""Calibration folds hold every class."""

from collections import Counter

from riskframe.operators import models as ML


def test_rare_class_is_in_every_fold(spark):
    rows = [(i, int(i < 4)) for i in range(1001)] + [(5, 0)] * 50  # four positives, a repeated id
    df = spark.createDataFrame(rows, "row_id long, label int")
    got = Counter((r["label"], r["_fold"]) for r in ML.calibration_folds(df).collect())
    assert sorted(n for (y, _), n in got.items() if y == 1) == [1, 1, 2]
    assert sorted(n for (y, _), n in got.items() if y == 0) == [349, 349, 349]
    assert set(got) == {(y, k) for y in (0, 1) for k in range(3)}
