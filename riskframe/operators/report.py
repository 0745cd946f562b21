"""Rankings and the Markdown comparison report (O1, O2, O4, X9, S11 lines).

Report rows are rendered by Spark (``concat_ws`` over the ordered columns); the line numbers come from a
small window over the top-k rows of each table, so the report never depends on collect order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.session import materialize

# The report's column order (only the columns present are shown) and its texts.
REPORT_COLUMNS = ("model", "hybrid_model", "accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc", "loss")
TITLE = "# Model Comparison Report"
SINGLE_TITLE = "## Top Single Models"
HYBRID_TITLE = "## Top Hybrid Models"
SUMMARY_TITLE = "## Summary File"
STATUS_TITLE = "## Status"
DECIMALS = 6


def ranked(metrics: DataFrame, by: Sequence[str] = (), key: str = "f1", name: str = "model") -> DataFrame:
    """O1: rank by ``key`` descending (name ascending on ties) within ``by``."""
    w = Window.partitionBy(*by).orderBy(F.desc(key), name)
    return metrics.withColumn("rank", F.row_number().over(w))


def last_round(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The row of the highest round (per ``by`` group)."""
    cols = [c for c in log.columns if c not in by]
    return log.groupBy(*by).agg(F.max_by(F.struct(*cols), F.col("round")).alias("_last")).select(*by, "_last.*")


def _cell(c: str, t: str):
    if t in ("double", "float"):
        return F.round(F.col(c), DECIMALS).cast("string")
    return F.col(c).cast("string")


def markdown_table(metrics: DataFrame, top_k: int, start: int, name: str = "model") -> DataFrame:
    """Header, separator and the top-k rows by F1 as ``(line_no, line)`` starting at ``start``."""
    df = metrics.withColumnRenamed("model", name) if name != "model" else metrics
    cols = [c for c in REPORT_COLUMNS if c in df.columns]
    types = dict(df.dtypes)
    spark = df.sparkSession
    head = spark.createDataFrame(
        [(start, "| " + " | ".join(cols) + " |"), (start + 1, "| " + " | ".join(["---"] * len(cols)) + " |")],
        "line_no int, line string")
    body = ranked(df, key="f1", name=name).where(F.col("rank") <= top_k).select(
        (F.col("rank") + F.lit(start + 1)).cast("int").alias("line_no"),
        F.concat(F.lit("| "), F.concat_ws(" | ", *[_cell(c, types[c]) for c in cols]), F.lit(" |")).alias("line"))
    return head.unionByName(body)


def _text(spark: SparkSession, lines) -> DataFrame:
    return spark.createDataFrame([(i, t) for i, t in lines], "line_no int, line string")


def comparison_report(singles: DataFrame | None, hybrids: DataFrame | None, top_k: int = 5,
                      summary: str | None = None) -> DataFrame:
    """The report as ``(line_no, line)``; a status variant when either metrics table is missing or empty."""
    present = [d for d in (singles, hybrids) if d is not None]
    spark = present[0].sparkSession if present else SparkSession.getActiveSession()
    singles, hybrids = (None if d is None else materialize(d) for d in (singles, hybrids))  # small tables read several times
    absent = [name for name, d in (("single models", singles), ("blends", hybrids)) if d is None or d.isEmpty()]
    if absent:
        return _text(spark, enumerate([TITLE, "", STATUS_TITLE, "", *(f"There are no metrics of {name} to rank." for name in absent)]))
    n1 = min(top_k, singles.count())
    n2 = min(top_k, hybrids.count())
    s0 = 4                      # title, blank, section title, blank
    h0 = s0 + 2 + n1 + 3        # table, blank, section title, blank
    tail = h0 + 2 + n2
    lines = [(0, TITLE), (1, ""), (2, SINGLE_TITLE), (3, ""), (s0 + 2 + n1, ""), (s0 + 3 + n1, HYBRID_TITLE),
             (s0 + 4 + n1, ""), (tail, "")]
    if summary:
        lines += [(tail + 1, SUMMARY_TITLE), (tail + 2, ""), (tail + 3, f"- `{summary}`"), (tail + 4, "")]
    return (_text(spark, lines)
            .unionByName(markdown_table(singles, top_k, s0))
            .unionByName(markdown_table(hybrids, top_k, h0, name="hybrid_model")))
