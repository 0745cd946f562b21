"""Scans of the input tables (S1) and a view registry for SQL text shared with the DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one input table; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """Load a raw transaction table.  Parquet is the default; CSV takes ``header`` and a schema.

    Pass an explicit ``schema`` for CSV at scale: schema inference reads the data an extra time.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def register_views(spark: SparkSession, sf_dir: str, names=("events", "customer", "nation", "orders", "lineitem", "embeddings")) -> None:
    """Register the input tables as temp views so that fixture SQL runs unchanged in Spark and DuckDB."""
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
