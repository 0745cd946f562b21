"""Rank cuts read their input once and tell equal ids apart."""

from pyspark.sql import functions as F

from riskframe.operators.rank import assign_by_rank, intervals_from_sizes
from riskframe.operators.split import stratified_split, subsample


def halves(first):
    def segments(totals):
        return intervals_from_sizes(totals, [], F.array(F.lit(first), F.col("n") - first), F.array(F.lit("a"), F.lit("b")), "part")

    return segments


def test_base_table_is_not_read_again(spark, tmp_path):
    spark.range(5000).select(F.col("id").alias("row_id"), (F.col("id") % 7 == 0).cast("int").alias("label")).write.parquet(str(tmp_path / "t"))
    out = stratified_split(spark.read.parquet(str(tmp_path / "t")))
    plan = out._jdf.queryExecution().toString()
    assert "FileScan" not in plan and "Scan ExistingRDD" in plan
    assert out.count() == 5000 and "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_a_million_equal_ids(spark):
    """One id holds nearly all rows: sizes stay exact, every row comes out once."""
    df = spark.range(1_000_000).select(F.lit(7).cast("long").alias("row_id"), F.lit(0).alias("label"), F.col("id").alias("n")).unionByName(
        spark.range(500).select(F.col("id").alias("row_id"), F.lit(0).alias("label"), (-F.col("id")).alias("n")))
    out = stratified_split(df)
    got = {r["split"]: (r["count"], r["d"]) for r in out.groupBy("split").agg(F.count("*").alias("count"), F.countDistinct("n").alias("d")).collect()}
    n = 1_000_500
    t = n * 70 // 100
    v = (n - t) * 50 // 100
    assert {k: c for k, (c, _) in got.items()} == {"train": t, "val": v, "test": n - t - v} and all(c == d or d >= c - 1 for c, d in got.values())


def test_every_digit_is_used(spark):
    """With a window of one row each cut is found by digits alone, through ties of hash and id."""
    rows = [(i % 5, h << 20, i) for i in range(60) for h in (1, 1, 9)]
    df = spark.createDataFrame(rows, "row_id long, h int, n int")
    out = assign_by_rank(df, hash_col="h", tiebreak="row_id", segments=halves(70), window_rows=1)
    parts = [(r["h"], r["row_id"], r["part"]) for r in out.collect()]
    a = sorted(x[:2] for x in parts if x[2] == "a")
    assert len(parts) == 180 and a == sorted(x[:2] for x in parts)[:70]


def test_empty_null_and_single(spark):
    empty = spark.createDataFrame([], "row_id long, label int")
    assert stratified_split(empty).collect() == [] and subsample(empty, 5).collect() == []
    one = stratified_split(spark.createDataFrame([(None, None)], "row_id long, label int")).collect()
    assert [(r["row_id"], r["label"], r["split"]) for r in one] == [(None, None, "test")]
