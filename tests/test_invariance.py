"""Empty inputs, and results that must not depend on partitioning or row order."""

import pytest

from riskframe.operators import metrics as M
from riskframe.operators.split import partition_clients, stratified_split, subsample
from riskframe.sources.fixtures import scores


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "row_id long, label int")
    assert stratified_split(empty).count() == 0
    assert partition_clients(empty, "iid").count() == 0
    assert subsample(empty, 10).count() == 0
    s = spark.createDataFrame([], "model string, label int, score double")
    assert M.model_metrics(s, ["model"]).count() == 0
    assert M.threshold_metrics(s, ["model"]).count() == 0


def test_metrics_independent_of_partitions_and_order(spark):
    base = scores(spark, "/root/testdata/sf0.001")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = sorted(M.model_metrics(base, ["model"]).collect())
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        b = sorted(M.model_metrics(base.repartition(7).orderBy("score"), ["model"]).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert len(a) == len(b) == 4
    for x, y in zip(a, b):
        assert x["model"] == y["model"] and x["n"] == y["n"] and x["f1"] == y["f1"]
        assert x["roc_auc"] == pytest.approx(y["roc_auc"], abs=1e-12)
        assert x["pr_auc"] == pytest.approx(y["pr_auc"], abs=1e-12)
