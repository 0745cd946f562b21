"""Independent fits run side by side: the models of a comparison and the folds of the calibrated SVM."""

import threading

from pyspark.ml.linalg import Vectors

from riskframe.operators import models as ML
from riskframe.plans.compare import run_comparison


def rows(spark):
    split = ("train", "train", "train", "val", "test")
    return spark.createDataFrame([(i, i % 2, split[i // 2 % 5], Vectors.dense(i % 2 + i % 7 / 10, i % 3)) for i in range(200)],
                                 ["row_id", "label", "split", "features"])


def test_models_of_a_comparison(spark):
    met = threading.Barrier(2, timeout=60)

    def waiting(fit):
        return lambda train: (met.wait(), fit(train, maxDepth=3))[1]

    cmp = run_comparison(rows(spark), None, {"decision_tree": waiting(ML.fit_tree), "other": waiting(ML.fit_tree)}, ())
    assert {(r["split"], r["model"]) for r in cmp.metrics.collect()} == {(s, m) for s in ("val", "test") for m in ("decision_tree", "other")}


def test_folds_of_the_svm(spark, monkeypatch):
    met, plain, parts = threading.Barrier(3, timeout=60), ML.with_class_weights, []

    def waiting(train, label):
        parts.append(train.rdd.getNumPartitions())
        met.wait()
        return plain(train, label)

    monkeypatch.setattr(ML, "with_class_weights", waiting)
    train = rows(spark).where("split = 'train'").repartition(40)
    assert len(ML.fit_svm_calibrated(train).pairs) == 3
    assert parts == [1, 1, 1]  # stored in as many partitions as they fill


def test_a_failing_fit_fails_the_whole(spark):
    def bad():
        raise ValueError("no rows")

    try:
        ML.fit_together(spark, {"a": lambda: 1, "b": bad})
    except ValueError as e:
        assert str(e) == "no rows"
    else:
        raise AssertionError
    assert ML.fit_together(spark, {"a": lambda: 1, "b": lambda: 2}) == {"a": 1, "b": 2} and ML.fit_together(spark, {}) == {}
