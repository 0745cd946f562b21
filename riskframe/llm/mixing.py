"""Mixing sources to target weights: hash-threshold histograms.

Sizes are summed by (source, hash bucket); a running sum over at most 4,096 buckets of a source finds the
bucket in which its budget ends; only that boundary bucket is counted again by the next 12 bits, until it
holds one hash value.  A plain filter ``hash < threshold`` then picks the documents: no rows are sorted, and a
smaller budget always picks a subset of a larger one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm.common import checked_broadcast, staged, table

HASH_BITS, LEVEL_BITS = 60, 12
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix_hash(keys: Sequence[Column], seed: int) -> Column:
    """60-bit order hash of one or more keys (a null key hashes as the empty string)."""
    text = F.concat(F.lit(f"{seed}"), *[x for k in keys for x in (F.lit(":"), F.coalesce(k.cast("string"), F.lit("")))])
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Targets of the sources in ``sizes(source, source_size)``, one row per source.

    Sources by code point (null last) weigh ``weights``, repeating.  ``share`` times the total is dealt by weight;
    a target stops at ``cap`` times its source's size and the excess goes to the others by weight.  The fill
    level is found by one pass over the sources ordered by the level at which each is full.
    """
    n = len(weights)
    total = Window.partitionBy(F.lit(0))
    rank = (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1) % n
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank + 1).cast("int"))
    s = (sizes.withColumn("weight", weight)
         .withColumn("full_at", F.col("source_size") * float(cap) / F.col("weight"))
         .withColumn("budget", F.sum("source_size").over(total) * float(share)))
    upto = Window.partitionBy(F.lit(0)).orderBy("full_at")  # a range frame: ties count together
    s = s.withColumn("at_full", F.sum(F.col("source_size") * float(cap)).over(upto)
                     + F.col("full_at") * (F.sum("weight").over(total) - F.sum("weight").over(upto)))
    s = s.withColumn("is_full", F.col("at_full") <= F.col("budget"))
    level = ((F.col("budget") - F.sum(F.when(F.col("is_full"), F.col("source_size") * float(cap)).otherwise(0.0)).over(total))
             / F.nullif(F.sum(F.when(F.col("is_full"), 0.0).otherwise(F.col("weight"))).over(total), F.lit(0.0)))
    s = s.withColumn("level", level)
    target = F.when(F.col("is_full") | F.col("level").isNull(), F.col("source_size") * float(cap)).otherwise(
        F.least(F.col("source_size") * float(cap), F.col("level") * F.col("weight")))
    return s.select("source", "source_size", "weight", target.alias("target"))


def _boundary(base: DataFrame, hash_col: str, ends: DataFrame, n_sources: int) -> DataFrame:
    """``(source, rest, before, words, hi)``: the hash value at which each source's budget ends, with the words before it and at it.

    ``ends(source, rest, prefix, before)`` holds one row per source; each level counts the rows of one bucket by the next bits.
    """
    small = lambda df: checked_broadcast(df, n_sources)  # noqa: E731  one row per source
    for used in range(0, HASH_BITS, LEVEL_BITS):
        inside = base if not used else base.join(
            small(ends.select(F.col("source").alias("s"), F.col("prefix").alias("p"))),
            F.col("source").eqNullSafe(F.col("s")) & (F.shiftright(hash_col, HASH_BITS - used) == F.col("p"))).drop("s", "p")
        cells = (inside.groupBy("source", F.shiftright(hash_col, HASH_BITS - used - LEVEL_BITS).alias("cell"))
                 .agg(F.sum("size").cast("long").alias("words"), F.min(hash_col).alias("lo"), F.max(hash_col).alias("hi"))
                 .join(small(ends.select(F.col("source").alias("s"), "rest", "before")), F.col("source").eqNullSafe(F.col("s"))))
        upto = Window.partitionBy("source").orderBy("cell")
        ends = staged(cells.withColumn("after", F.col("before") + F.sum("words").over(upto))
                      .where((F.col("after") > F.col("rest")) & (F.col("after") - F.col("words") <= F.col("rest")))
                      .select("source", "rest", F.col("cell").alias("prefix"), (F.col("after") - F.col("words")).alias("before"),
                              "words", "lo", "hi"), "cells")
        if ends.where("lo < hi").isEmpty():  # each boundary bucket is down to one hash value
            break
    return ends.select("source", "rest", "before", "words", "hi")


def mix_sources(docs: DataFrame, id_col: str, source_col: str, size: Column, *, weights: Sequence[float] = (5, 2, 1),
                share: float = 1.5, cap: float = 2.0, seed: int = 17, also: Sequence[str] = ()) -> DataFrame:
    """One row per input row: ``id, source, size, source_size, target, copies, taken``.

    Every document is taken ``floor(target / source_size)`` times; those below the source's hash threshold once more, so that
    the taken words end within half a document of the target.  The hash is of the id and the columns ``also``; rows equal in
    all of them are told apart by a stored row number, so null and repeated ids are taken one by one too (reruns agree on what they take if such
    rows are equal, which ``also`` the text makes sure of).  Null sources form one source; sizes of null text are 0; a source without words is taken 0 times; an empty table
    gives an empty one.
    """
    base = staged(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"),
                              mix_hash([F.col(c) for c in (id_col, *also)], seed).alias("h"),
                              F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - HASH_BITS).alias("t")), "mix")
    sizes = base.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    targets = staged(source_targets(sizes, weights, share, cap)
                     .withColumn("epochs", F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0)).cast("long"))
                     .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "targets")
    n_sources = targets.count()
    small = lambda df: checked_broadcast(df, n_sources)  # noqa: E731  one row per source

    start = lambda df: df.select("source", "rest", F.lit(0).cast("long").alias("prefix"), "before")
    at = _boundary(base.select("source", "size", "h"), "h", start(targets.withColumn("before", F.lit(0).cast("long"))), n_sources)
    # Rows that share the boundary's hash, in the order of their row numbers' hash.
    equal = base.join(small(at.select(F.col("source").alias("s"), F.col("hi").alias("value"))),
                      F.col("source").eqNullSafe(F.col("s")) & (F.col("h") == F.col("value"))).select("source", "size", "t")
    end = _boundary(staged(equal, "equal"), "t", start(at), n_sources)
    # The boundary row itself is taken where that ends nearer to the budget.
    cut = end.select(F.col("source").alias("s2"), (F.col("hi") + F.when(
        F.col("before") + F.col("words") - F.col("rest") < F.col("rest") - F.col("before"), 1).otherwise(0)).alias("tie"))
    cut = small(at.select(F.col("source").alias("s"), F.col("hi").alias("threshold"))).join(small(cut), F.col("s").eqNullSafe(F.col("s2")))
    plan = (targets.join(small(cut), F.col("source").eqNullSafe(F.col("s")), "left")
            .select(F.col("source").alias("s"), "source_size", "target", "epochs", F.coalesce("threshold", F.lit(-1)).alias("threshold"), F.coalesce("tie", F.lit(0)).alias("tie")))
    more = (F.col("h") < F.col("threshold")) | ((F.col("h") == F.col("threshold")) & (F.col("t") < F.col("tie")))
    return (base.join(small(plan), F.col("source").eqNullSafe(F.col("s")))
            .withColumn("copies", F.col("epochs") + F.when(more, 1).otherwise(0))
            .select("id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mix_sources(table(spark, sf_dir, "documents"), "doc_id", "source", n_words(F.col("text")), also=["text"])
            .select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source", "copies"))


def oracle(documents: str = "documents", columns: str = "doc_id, size, source_size, target, taken, source, copies") -> str:
    """DuckDB twin: the same targets and, by plain running sums over the hash order, the same picks."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
  ('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h FROM {documents}),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
  CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS budget FROM s),
f AS (SELECT *, source_size * 2.0::DOUBLE / weight AS full_at FROM w),
g AS (SELECT *, sum(source_size * 2.0::DOUBLE) OVER (ORDER BY full_at) + full_at * (sum(weight) OVER () - sum(weight) OVER (ORDER BY full_at)) <= budget AS is_full FROM f),
l AS (SELECT *, (budget - sum(CASE WHEN is_full THEN source_size * 2.0::DOUBLE ELSE 0.0 END) OVER ())
  / nullif(sum(CASE WHEN is_full THEN 0.0 ELSE weight END) OVER (), 0.0) AS lev FROM g),
t AS (SELECT source, source_size, CASE WHEN is_full OR lev IS NULL THEN source_size * 2.0::DOUBLE
  ELSE least(source_size * 2.0::DOUBLE, lev * weight) END AS target FROM l),
e AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target / source_size) AS BIGINT) END AS epochs FROM t),
c AS (SELECT d.rid, source_size, d.size AS words, target - epochs * source_size AS rest,
  CAST(sum(size) OVER (PARTITION BY d.source ORDER BY h, rid ROWS UNBOUNDED PRECEDING) AS BIGINT) AS after_it
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
p AS (SELECT rid, source_size > 0 AND (after_it <= rest OR (after_it - words <= rest AND after_it - rest < rest - (after_it - words))) AS more FROM c)
SELECT {columns} FROM (SELECT doc_id, size, source_size, target, (epochs + CASE WHEN more THEN 1 ELSE 0 END) * size AS taken, d.source AS source,
  epochs + CASE WHEN more THEN 1 ELSE 0 END AS copies
FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source JOIN p ON p.rid = d.rid)"""
