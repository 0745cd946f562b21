"""Sinks and re-reads.

Every output is a distributed write of a DataFrame; the only single-file output is the Markdown report
(a handful of lines).  Split outputs are partitioned by ``split`` so a trainer's read of one split is
pruned to its folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.operators.prep import FittedPrep, dense_features, with_sizes

METRICS_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("f1", T.DoubleType()),
    T.StructField("roc_auc", T.DoubleType()),
    T.StructField("pr_auc", T.DoubleType()),
])


def write_features(vectors: DataFrame, path: str) -> None:
    """Feature vectors and labels, one folder per split."""
    vectors.select("row_id", "split", "features", "label").write.mode("overwrite").partitionBy("split").parquet(path)


def write_dense(vectors: DataFrame, path: str) -> None:
    """S3: dense float32 features (``array<float>``), one folder per split."""
    dense_features(vectors, "features", "x").select("row_id", "split", "x", "label") \
        .write.mode("overwrite").partitionBy("split").parquet(path)


def write_prep(prep: FittedPrep, spark: SparkSession, path: str) -> None:
    """The category dictionary and the fitted statistics table."""
    prep.dictionary.write.mode("overwrite").parquet(f"{path}/dictionary")
    prep.statistics(spark).write.mode("overwrite").parquet(f"{path}/statistics")


COMMIT_SCHEMA = "version int, folder string, numeric array<string>, categorical array<string>"


def committed(spark: SparkSession, path: str) -> list:
    """Versions of ``path`` in order; a folder without a commit record is no version."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/commits")
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return []
    return sorted(spark.read.schema(COMMIT_SCHEMA).parquet(f"{path}/commits").collect(), key=lambda r: (r["version"], r["folder"]))


def write_version(split: DataFrame, prep: FittedPrep, path: str) -> int:
    """S2 + S4 as one committed version: sparse features per split, statistics and category dictionary.

    The tables go into a folder of their own; the version exists once its record is appended to ``commits`` (Spark's own output
    commit), so a reader never sees half of one and a failed write leaves earlier versions as they were.
    """
    spark = split.sparkSession
    version = max((r["version"] for r in committed(spark, path)), default=0) + 1
    folder = f"data-{version}-{uuid.uuid4().hex}"
    rows = prep.sparse_rows(split, ["row_id", "split", "label"])
    rows.write.partitionBy("split").parquet(f"{path}/{folder}/features")
    write_prep(prep, spark, f"{path}/{folder}")
    record = spark.createDataFrame([(version, folder, prep.numeric, prep.categorical)], COMMIT_SCHEMA)
    record.coalesce(1).write.mode("append").parquet(f"{path}/commits")
    return version


def _folder(spark: SparkSession, path: str, version: int | None):
    found = [r for r in committed(spark, path) if version is None or r["version"] == version]
    if not found:
        raise ValueError(f"{path} holds no committed version" + ("" if version is None else f" {version}"))
    return found[-1]


def read_version(spark: SparkSession, path: str, split: str, version: int | None = None) -> DataFrame:
    """One split of a committed version, the last unless given; only that split's folder is read."""
    folder = _folder(spark, path, version)["folder"]
    schema = "row_id long, label int, size int, indices array<int>, values array<double>, split string"
    return spark.read.schema(schema).parquet(f"{path}/{folder}/features").where(F.col("split") == split)


def load_prep(spark: SparkSession, path: str, version: int | None = None) -> FittedPrep:
    """S4 read back: the fitted statistics and the dictionary of a committed version, ready to transform rows."""
    record = _folder(spark, path, version)
    base = f"{path}/{record['folder']}"
    stats = {(r["col_name"], r["stat"]): r for r in spark.read.parquet(f"{base}/statistics").collect()}  # a few numbers per column
    pick = lambda cols, stat, field: {c: stats[c, stat][field] for c in cols if stats[c, stat][field] is not None}
    numeric, categorical = list(record["numeric"]), list(record["categorical"])
    dictionary = spark.read.schema("cpos int, category string, idx long").parquet(f"{base}/dictionary")
    return with_sizes(numeric, categorical, pick(numeric, "median", "value"), pick(numeric, "mean", "value"), pick(numeric, "scale", "value"),
                      pick(categorical, "mode", "text"), dictionary)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split of a written feature table (partition pruning reads only its folder)."""
    return spark.read.parquet(path).where(F.col("split") == split)


def write_json(df: DataFrame, path: str) -> None:
    """A metrics table as JSON lines."""
    df.write.mode("overwrite").json(path)


def result_document(results: DataFrame, threshold: float) -> DataFrame:
    """A results table (one row per model) as one document: the threshold and the rows, best F1 first."""
    name = "hybrid_model" if "hybrid_model" in results.columns else "model"
    rows = F.sort_array(F.collect_list(F.struct((-F.col("f1")).alias("_order"), F.struct(name, *[c for c in results.columns if c != name]).alias("row"))))
    return results.agg(F.lit(float(threshold)).alias("threshold"), F.transform(rows, lambda r: r["row"]).alias("results"))


def write_csv(df: DataFrame, path: str) -> None:
    """A metrics table as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_metrics_csv(spark: SparkSession, path: str, schema: T.StructType = METRICS_SCHEMA) -> DataFrame:
    """Read a metrics CSV back with a fixed schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def with_loss(df: DataFrame, loss: float) -> DataFrame:
    """Attach a loss column before writing."""
    return df.withColumn("loss", F.lit(float(loss)))


def write_report(lines: DataFrame, path: str) -> None:
    """The Markdown report (``line_no, line``) as one text file; the table is a few dozen rows."""
    lines.orderBy("line_no").select("line").coalesce(1).write.mode("overwrite").text(path)


def manifest(split: DataFrame, prep: FittedPrep, roles, target: str) -> DataFrame:
    """One row with the resolved roles, dropped columns, feature names and per-split class ratios."""
    ratios = split.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("fraud_count"),
        F.avg((F.col("label") == 1).cast("double")).alias("fraud_ratio"))
    one = ratios.agg(F.map_from_entries(F.collect_list(F.struct("split", F.struct("n", "fraud_count", "fraud_ratio")))).alias("fraud_ratio"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("pos", "feature"))), lambda x: x["feature"])
    names = prep.names().agg(ordered.alias("feature_names"))
    # Two tables of one row side by side.
    both = one.unionByName(names, allowMissingColumns=True).agg(F.max_by("fraud_ratio", F.col("fraud_ratio").isNotNull()).alias("fraud_ratio"),
                                                               F.max("feature_names").alias("feature_names"))
    return both.select(
        F.lit(target).alias("target_column"),
        F.lit(roles.amount).alias("detected_amount_column"),
        F.lit(roles.balance).alias("detected_balance_column"),
        F.array_sort(F.array(*[F.lit(c) for c in roles.dropped]).cast("array<string>")).alias("dropped_columns"),
        F.array(*[F.lit(c) for c in prep.numeric]).cast("array<string>").alias("numeric_columns"),
        F.array(*[F.lit(c) for c in prep.categorical]).cast("array<string>").alias("categorical_columns"),
        F.lit(prep.n_features).alias("n_features_after_preprocessing"),
        "feature_names",
        "fraud_ratio",
    )


def manifest_rows(split: DataFrame, prep: FittedPrep, roles, target: str, dropped_rows: int) -> DataFrame:
    """S5 as a table ``(entry, pos, text, number)``, one row per value, so that nothing grows inside a row.

    Entries: target, amount and balance column, dropped, numeric and categorical columns (by position), features, rows that the
    label filter dropped (P6), and n, positives and positive share per split.
    """
    spark = split.sparkSession
    rows = [("target_column", 0, target, None), ("amount_column", 0, roles.amount, None), ("balance_column", 0, roles.balance, None),
            ("dropped_rows", 0, None, float(dropped_rows)), ("n_features", 0, None, float(prep.n_features))]
    for entry, names in (("dropped_column", sorted(roles.dropped)), ("numeric_column", prep.numeric), ("categorical_column", prep.categorical)):
        rows += [(entry, i, c, None) for i, c in enumerate(names)]
    fixed = spark.createDataFrame(rows, "entry string, pos int, text string, number double")
    features = prep.names().select(F.lit("feature").alias("entry"), "pos", F.col("feature").alias("text"), F.lit(None).cast("double").alias("number"))
    per_split = split.groupBy("split").agg(F.count(F.lit(1)).cast("double").alias("n"), F.count_if(F.col("label") == 1).cast("double").alias("k"))
    ratios = per_split.select(F.expr("stack(3, 'n', n, 'fraud_count', k, 'fraud_ratio', k / n) as (entry, number)"), F.lit(0).alias("pos"),
                              F.col("split").alias("text"))
    return fixed.unionByName(features).unionByName(ratios)
