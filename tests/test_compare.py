"""Model comparison in one pass, result documents, baseline, versions on storage."""

import json
import math

import pytest
from pyspark.sql import functions as F

from riskframe.catalog.fitted import fitted
from riskframe.operators import models as ML
from riskframe.operators import scoring as SC
from riskframe.operators.features import sanitize_target, target_drop_count
from riskframe.operators.split import subsample, training_sample
from riskframe.plans.compare import central_baseline, run_comparison
from riskframe.session import materialize
from riskframe.sources import sinks

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def parts(spark):
    split, prep = fitted(spark, SF)
    return split, prep, materialize(prep.transform(split).select("row_id", "split", "label", "features"))


def test_wide_scores_equal_single_models(spark, parts):
    vectors = parts[2]
    train, test = vectors.where("split = 'train'"), vectors.where("split = 'test'")
    models = {"lr": ML.fit_logistic(train), "svm": ML.fit_svm_calibrated(train), "tree": ML.fit_tree(train),
              "forest": ML.fit_forest(train, numTrees=5), "boosted": ML.fit_boosted(train, maxIter=3)}
    wide = SC.model_wide(models, test)
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Union" not in plan and wide.columns == ["row_id", "label", *models]
    got = {r["row_id"]: r for r in wide.collect()}
    for name, model in models.items():
        for r in ML.positive_scores(model, test, name).collect():
            assert got[r["row_id"]][name] == pytest.approx(r["score"], abs=1e-12)
    long = SC.stacked(wide, list(models), [("lr", "svm", 0.7, 0.3), ("lr", "nobody", 0.5, 0.5)]).where("kind = 'hybrid'").collect()
    assert {r["model"] for r in long} == {"lr+svm_w70_30"} and len(long) == len(got)
    assert all(r["score"] == pytest.approx(0.7 * got[r["row_id"]]["lr"] + 0.3 * got[r["row_id"]]["svm"]) for r in long)


def test_linear_models_score_each_row_by_itself(spark, parts):
    """Different rows under one key keep their own score, unseen categories and unknown names count nothing."""
    split, prep, _ = parts
    coefs = spark.createDataFrame([("m", SC.INTERCEPT, 0.5), ("m", "num__tx_hour", 2.0), ("m", "cat__Segment_BUILDING", -1.0), ("m", "num__none", 7.0),
                                   ("flat", SC.INTERCEPT, -1.0)], "model string, feature string, coef double")
    rows = split.limit(40).withColumn("row_id", F.lit(1).cast("long")).withColumn("Segment", F.when(F.col("tx_hour") > 20, "new").otherwise(F.col("Segment")))
    out = SC.linear_wide(prep, rows, coefs, ("row_id", "tx_hour", "Segment")).collect()
    assert len(out) == 40
    for r in out:
        hour = prep.medians["tx_hour"] if r["tx_hour"] is None else r["tx_hour"]
        z = 0.5 + 2 * (hour - prep.means["tx_hour"]) / prep.scales["tx_hour"] - (r["Segment"] == "BUILDING")
        assert r["m"] == pytest.approx(1 / (1 + math.exp(-z))) and r["flat"] == pytest.approx(1 / (1 + math.e))


def test_comparison_files_and_bands(spark, parts, tmp_path):
    models = {"logistic_regression": ML.fit_logistic, "decision_tree": ML.fit_tree}
    cmp = run_comparison(parts[2], str(tmp_path), models, [("decision_tree", "logistic_regression", 0.7, 0.3)], max_train_samples=500, threshold=0.4)
    rows = cmp.metrics.collect()
    assert len(rows) == 6 and {(r["threshold"], r["train_rows"]) for r in rows} == {(0.4, 500)}
    assert all(r["roc_auc"] > 0.8 for r in rows) and sorted(r["rank"] for r in rows if r["split"] == "test" and r["kind"] == "single") == [1, 2]
    val = {k: max((r["f1"], r["model"]) for r in rows if r["split"] == "val" and r["kind"] == k)[1] for k in ("single", "hybrid")}
    assert all(r["chosen"] == (val[r["kind"]] == r["model"]) for r in rows)
    (line,) = [r["value"] for r in spark.read.text(str(tmp_path / "metrics/ml_single_results_json")).collect()]
    doc = json.loads(line)
    assert doc["threshold"] == 0.4 and [x["f1"] for x in doc["results"]] == sorted((x["f1"] for x in doc["results"]), reverse=True) and len(doc["results"]) == 2
    s = spark.read.json(str(tmp_path / "metrics/ml_comparison_summary")).first()
    assert s["train_samples_used"] == 500 and s["best_single"]["model"] == val["single"] and s["best_hybrid"]["model"] == val["hybrid"]


def test_central_baseline_fits_on_all_train_rows(spark, parts, tmp_path):
    out = central_baseline(parts[2], str(tmp_path)).collect()
    metric = {r["item"]: r["value"] for r in out if r["part"] == "metric"}
    assert metric["roc_auc"] > 0.8 and metric["loss"] > 0 and metric["n"] == sum(r["value"] for r in out if r["part"] == "confusion")
    assert sum(r["part"] == "roc" for r in out) == sum(r["part"] == "pr" for r in out) > 10
    report = {r["item"]: r["value"] for r in out if r["part"] == "report"}
    assert report["1:f1"] == pytest.approx(metric["f1"])
    assert "loss" in spark.read.option("header", True).csv(str(tmp_path / "metrics/centralized_results")).columns


def test_versions(spark, parts, tmp_path):
    split, prep, _ = parts
    path = str(tmp_path / "v")
    with pytest.raises(ValueError, match="no committed version"):
        sinks.read_version(spark, path, "val")
    assert sinks.write_version(split, prep, path) == 1 and sinks.write_version(split.where("label = 1"), prep, path) == 2
    val = sinks.read_version(spark, path, "val", 1)
    assert val.count() == split.where("split = 'val'").count()
    assert "PartitionFilters: [isnotnull(split" in val._jdf.queryExecution().executedPlan().toString()
    assert sinks.read_version(spark, path, "val").count() == split.where("split = 'val' and label = 1").count()
    # A folder without a commit record is no version.
    split.limit(1).write.parquet(f"{path}/data-9-x/features")
    assert [r["version"] for r in sinks.committed(spark, path)] == [1, 2]
    again = sinks.load_prep(spark, path, 1)
    assert (again.medians, again.means, again.scales, again.modes, again.sizes, again.starts) == (prep.medians, prep.means, prep.scales, prep.modes, prep.sizes, prep.starts)
    assert sorted(map(tuple, again.entries(split).collect())) == sorted(map(tuple, prep.entries(split).collect()))


def test_dropped_labels_are_counted(spark):
    df = spark.createDataFrame([("0",), ("1",), ("2",), ("x",), (None,), ("1.0",)], "y string")
    kept = materialize(sanitize_target(df, "y"))
    assert kept.count() == 3 and target_drop_count(df, kept) == 3


def test_training_sample_fills_its_partitions(spark):
    """The capped rows are those of the plain subsample, in a number of partitions that the input's does not change."""
    few, many = (spark.range(3_000, numPartitions=p).withColumnRenamed("id", "row_id") for p in (1, 50))
    cut = [training_sample(df, 1_000, part_rows=300) for df in (few, many)]
    assert [c.rdd.getNumPartitions() for c in cut] == [4, 4]
    assert cut[0].rdd.glom().map(lambda p: [r[0] for r in p]).collect() == cut[1].rdd.glom().map(lambda p: [r[0] for r in p]).collect()
    assert {r[0] for r in cut[0].collect()} == {r[0] for r in subsample(many, 1_000).collect()}
    assert training_sample(many, 1_000).rdd.getNumPartitions() == 1
    assert training_sample(many, 0).count() == 3_000
