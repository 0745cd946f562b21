"""End-to-end plans with their sinks on the smallest tables (fewer trees than the defaults)."""

import functools
import tempfile

from pyspark.sql import functions as F

from riskframe.operators import models as ML
from riskframe.plans.compare import run_comparison
from riskframe.plans.grouped_training import TrainConfig, run_grouped_training
from riskframe.plans.preprocess import run_preprocess
from riskframe.sources import sinks
from riskframe.sources.fixtures import txn_raw

SF = "/root/testdata/sf0.001"


def test_preprocess_compare_and_report(spark):
    out = tempfile.mkdtemp(prefix="riskframe-test-")
    prep = run_preprocess(txn_raw(spark, SF), out, row_key="Transaction_ID")
    assert prep.vectors.count() == 981
    train = sinks.read_split(spark, f"{out}/processed/features", "train")
    assert train.count() == prep.split.where("split = 'train'").count()
    dense = spark.read.parquet(f"{out}/processed/dense")
    assert dict(dense.dtypes)["x"] == "array<float>"
    man = spark.read.json(f"{out}/processed/manifest").first()
    assert man["detected_amount_column"] == "Transaction_Amount"
    assert man["dropped_columns"] == ["Customer_ID", "Customer_Name", "Transaction_ID"]
    ratios = spark.read.option("header", True).csv(f"{out}/metrics/split_fraud_ratio")
    assert ratios.count() == 3

    models = {"logistic_regression": ML.fit_logistic,
              "random_forest": functools.partial(ML.fit_forest, numTrees=10),
              "xgboost": functools.partial(ML.fit_boosted, maxIter=10)}
    cmp = run_comparison(prep.vectors, out, models=models)
    m = cmp.metrics.where("split = 'test'").collect()
    assert {r["model"] for r in m} >= {"logistic_regression", "xgboost+logistic_regression_w70_30"}
    assert all(r["roc_auc"] is None or r["roc_auc"] > 0.5 for r in m if r["kind"] == "single")
    singles = sinks.read_metrics_csv(spark, f"{out}/metrics/ml_single_results")
    assert singles.count() == 3
    text = [r["value"] for r in spark.read.text(f"{out}/metrics/model_comparison_report").collect()]
    assert text[0] == "# Model Comparison Report" and "## Top Hybrid Models" in text
    assert cmp.best.count() == 2


def test_report_status_when_missing(spark):
    from riskframe.operators.report import comparison_report

    lines = comparison_report(None, None).orderBy("line_no").collect()
    assert lines[2]["line"] == "## Status"


def test_grouped_training_round_log(spark):
    prep = run_preprocess(txn_raw(spark, SF), None, row_key="Transaction_ID")
    res = run_grouped_training(prep.vectors, TrainConfig(rounds=2, partition_mode="bank_noniid",
                                                         aggregation="adaptive", secure_agg=True))
    log = res.round_log.orderBy("round").collect()
    assert [r["round"] for r in log] == [1, 2]
    w = res.weight_log.groupBy("round").agg(F.sum("weight").alias("s")).collect()
    assert all(abs(r["s"] - 1.0) < 1e-9 for r in w)
    assert res.final_metrics.count() == 1
