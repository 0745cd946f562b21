"""Radix medians, the category dictionary and sparse rows on inputs that sorting or driver lists would not stand."""

import inspect
import math
import random
import statistics

from pyspark.sql import functions as F

from riskframe.operators import prep as P


def median(spark, values):
    df = spark.createDataFrame([(v, 1.0) for v in values], "x double, y double")
    return {r["col_name"]: r["median"] for r in P.exact_medians(df, ["x", "y"]).collect()}.get("x")


def test_medians_of_awkward_values(spark):
    rng = random.Random(3)
    cases = [
        [rng.gauss(0, 1) for _ in range(999)], [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(1000)],
        [5.0] * 900 + [rng.random() for _ in range(100)], [0.0, -0.0, 0.0, 1e-320, -1e-320], [1.0, math.nextafter(1.0, 2)] * 3,
        [float("inf")] * 3 + [1.0, 2.0], [float("-inf"), 4.0, 4.5, float("inf")], [None, 3.0, None], [-2.0 ** k for k in range(-40, 40)],
        [1.0 + k * 2 ** -52 for k in range(5000)], [rng.randrange(100) / 100 for _ in range(2000)],
    ]
    for values in cases:
        assert median(spark, values) == statistics.median([v for v in values if v is not None])
    assert median(spark, [None, None]) is None
    nan = spark.createDataFrame([(float("nan"),), (1.0,), (3.0,)], "x double")
    assert P.exact_medians(nan, ["x"]).first()["median"] == 2.0


def test_median_of_a_hot_value_among_many(spark):
    """A third of 300,000 rows hold one value at the middle of a wide range; no pass windows or sorts values."""
    df = spark.range(300_000).select(F.when(F.col("id") % 3 == 0, F.lit(500.0)).otherwise(F.pmod(F.xxhash64("id"), F.lit(10**6)).cast("double") / 1000).alias("x"))
    assert P.exact_medians(df, ["x"]).first()["median"] == df.agg(F.median("x")).first()[0]
    assert "orderBy(\"x\")" not in inspect.getsource(P.exact_medians)


def test_a_hundred_thousand_categories(spark):
    n = 100_000
    df = spark.range(n + 50).select(F.col("id").alias("row_id"), (F.col("id") % 5).cast("double").alias("x"), F.concat(F.lit("k"), F.col("id") % n).alias("c"),
                                    F.when(F.col("id") % 2 == 0, "é").when(F.col("id") % 3 == 0, "a").alias("d"))
    prep = P.fit_prep(df, ["x"], ["c", "d"])
    assert prep.sizes == {"c": n, "d": 2} and prep.n_features == n + 3
    names = prep.names()
    want = sorted(f"cat__c_k{i}" for i in range(n))
    got = {r["pos"]: r["feature"] for r in names.where("pos in (0, 1, 2, 50001, 100000, 100001, 100002)").collect()}
    assert got == {0: "num__x", 1: want[0], 2: want[1], 50001: want[50000], 100000: want[-1], 100001: "cat__d_a", 100002: "cat__d_é"}
    assert names.select("pos").distinct().count() == n + 3
    rows = prep.sparse_rows(df.where("row_id in (0, 4, 99999)").unionByName(spark.createDataFrame([(-1, None, "new", None)], df.schema)))
    by_id = {r["row_id"]: r for r in rows.collect()}
    for i in (0, 4, 99999):
        assert names.where(F.col("pos").isin(by_id[i]["indices"]) & F.col("feature").startswith("cat__c")).first()["feature"] == f"cat__c_k{i}"
    assert by_id[-1]["indices"][-1:] == [100002] and by_id[-1]["size"] == n + 3 and all(p < 1 or p > n for p in by_id[-1]["indices"])
    # The same features as the estimators' vector, without an array of n numbers.
    vec = prep.transform(df.where("row_id = 4")).first()["features"]
    assert (vec.size, list(vec.indices), list(vec.values)) == (n + 3, by_id[4]["indices"], by_id[4]["values"])
    assert "vector_to_array" not in inspect.getsource(P.FittedPrep)


def test_dictionary_beyond_the_broadcast_limit_shuffles(spark):
    df = spark.createDataFrame([(i, float(i), "abc"[i % 3]) for i in range(30)], "row_id long, x double, c string")
    prep = P.fit_prep(df, ["x"], ["c"])
    small = sorted(map(tuple, prep.entries(df).collect()))
    prep.dictionary_bytes = P.DICTIONARY_BYTES + 1
    out = prep.entries(df)
    assert sorted(map(tuple, out.collect())) == small and "hint" not in out._jdf.queryExecution().optimizedPlan().toString().lower()


def test_no_categories_and_all_null(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 3.0, None)], "row_id long, x double, c string")
    prep = P.fit_prep(df, ["x"], ["c"])
    assert prep.sizes == {"c": 0} and prep.feature_names == ["num__x"]
    assert sorted(map(tuple, prep.entries(df).collect())) == [(1, 0, -1.0), (2, 0, 1.0)]
    assert [list(r["features"]) for r in prep.transform(df).orderBy("row_id").collect()] == [[-1.0], [1.0]]
    assert P.fit_prep(df, ["x"], []).feature_names == ["num__x"]
