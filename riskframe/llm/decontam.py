"""Benchmark decontamination by winnowing.

The fingerprint of a text is, for each window of ``SPAN - GRAM + 1`` consecutive word grams, the smallest gram
hash.  Any ``SPAN`` consecutive words shared with a benchmark item are such a window in both, so both keep
the same gram: joining fingerprints finds every shared span.  A hit is extended by the grams around it: a span of
``SPAN`` words equals an item's window if its first and its last ``GRAM``-word hashes do.  Items of fewer words are one window of
their own length and are looked up directly, for the lengths that occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import checked_broadcast, row_key, staged, table

SPAN, GRAM = 10, 5
# Words before lower-casing: A-Z belong to them too, so words are cut and counted on the text as it is.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lower_az(word: Column) -> Column:
    """``word`` with A-Z in lower case, other letters as they are.  ``translate`` costs a map lookup per character, so only words with
    A-Z beside non-ASCII letters pay for it."""
    return (F.when(F.octet_length(word) == F.char_length(word), F.lower(word))
            .when(word.rlike("[A-Z]"), F.translate(word, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(word))


def bench_words(text: Column) -> Column:
    """Words of a text after lower-casing A-Z; null has none.  ASCII texts are lower-cased whole, others word by word."""
    cut = lambda t: F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
    return F.coalesce(F.when(F.octet_length(text) == F.char_length(text), cut(F.lower(text))).otherwise(F.transform(cut(text), lower_az)),
                      F.array().cast("array<string>"))


def n_bench_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def grams(words: Column, size: int) -> Column:
    """Hash of the ``size`` words from each position on (empty for shorter texts)."""
    return F.when(F.size(words) >= size, F.transform(F.sequence(F.lit(1), F.size(words) - size + 1), lambda i: F.xxhash64(F.slice(words, i, size))))


def picks(hashes: Column, window: int) -> Column:
    """Winnowing: positions (0-based) of the smallest gram of every window, the first of equals; texts with fewer grams have none."""
    spans = F.transform(F.sequence(F.lit(1), F.size(hashes) - window + 1), lambda i: F.slice(hashes, i, window))
    return F.when(F.size(hashes) >= window, F.array_distinct(F.transform(spans, lambda s, i: i + F.array_position(s, F.array_min(s)).cast("int") - 1)))


def decontaminate(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", row_col: str | None = None) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` per row of ``docs``.

    A document word inside any occurrence of an item's window is hit.  Rows are known by ``row_col`` where it is given (a key of
    their own values, so that each is judged by its own text whatever its id), else by their id: rows of one id then count as one document
    for hits, null being an id too.  Null texts and items without words match nothing.
    """
    window = SPAN - GRAM + 1
    key = row_col or id_col
    texts = docs.select(F.col(key).alias("doc"), bench_words(F.col(text_col)).alias("words"))
    bench = staged(items.select(F.col(item_col).cast("string").alias("item"), bench_words(F.col(item_text)).alias("words")).where(F.size("words") > 0), "bench")
    long = bench.where(F.size("words") >= SPAN).select("item", grams(F.col("words"), GRAM).alias("g"))
    marks = long.select(F.explode(picks(F.col("g"), window)).alias("p"), "g").select(F.element_at("g", F.col("p") + 1).alias("mark")).distinct()
    spans = long.select("item", F.explode(F.transform(F.sequence(F.lit(0), F.size("g") - window), lambda i: F.struct(
        F.get("g", i).alias("head"), F.get("g", i + GRAM).alias("tail")))).alias("x")).select("item", "x.head", "x.tail").distinct()
    marks, spans = staged(marks, "marks"), staged(spans, "spans")
    n_marks, n_spans = marks.count(), spans.count()

    gram = texts.select("doc", grams(F.col("words"), GRAM).alias("g")).select("doc", "g", picks(F.col("g"), window).alias("p"))
    # Each fingerprint carries the grams around it; the words themselves stay behind.
    near = F.transform("p", lambda p: F.struct(p.alias("at"), F.get("g", p).alias("h"), F.greatest(p - (window - 1), F.lit(0)).alias("lo"),
                                               F.slice("g", F.greatest(p - (window - 1), F.lit(0)) + 1, p - F.greatest(p - (window - 1), F.lit(0)) + SPAN - GRAM + 1).alias("around")))
    prints = gram.select("doc", F.explode(near).alias("x")).select("doc", "x.*")
    hits = (prints.join(checked_broadcast(marks, n_marks), F.col("h") == F.col("mark"))
            .select("doc", "lo", F.col("around"), F.explode(F.sequence(F.lit(0), F.col("at") - F.col("lo"))).alias("i"))
            .select("doc", (F.col("lo") + F.col("i")).alias("start"), F.get("around", F.col("i")).alias("h1"), F.get("around", F.col("i") + GRAM).alias("h2"))
            .where("h2 is not null").distinct()
            .join(checked_broadcast(spans, n_spans), (F.col("h1") == F.col("head")) & (F.col("h2") == F.col("tail")))
            .select("doc", "start", F.lit(SPAN).alias("size"), "item"))
    for row in bench.where(F.size("words") < SPAN).groupBy(F.size("words").alias("n")).count().orderBy("n").collect():  # at most SPAN - 1 lengths
        n = row["n"]
        short = bench.where(F.size("words") == n).select("item", F.xxhash64("words").alias("mark"))
        found = (texts.select("doc", F.posexplode(grams(F.col("words"), n)).alias("start", "h"))
                 .join(checked_broadcast(short, row["count"]), F.col("h") == F.col("mark")).select("doc", "start", F.lit(n).alias("size"), "item"))
        hits = hits.unionByName(found)
    hits = staged(hits.distinct(), "hits")
    # Words covered by the union of the spans: each start reaches to its end or the next start, longest first.
    reach = hits.groupBy("doc", "start").agg(F.max("size").alias("size"))
    covered = (reach.select("doc", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)).alias("w")).distinct()
               .groupBy("doc").agg(F.count("*").alias("n_hit")))
    named = (hits.select("doc", "item").distinct().groupBy(F.col("doc").alias("d"))
             .agg(F.count("*").alias("n_items"), F.sha2(F.array_join(F.array_sort(F.collect_list("item")), ","), 256).alias("items_sha256")))
    found = covered.join(named, F.col("doc").eqNullSafe(F.col("d"))).drop("d")
    found = staged(found, "found")
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(key).alias("__key"), n_bench_words(F.col(text_col)).alias("n_words"))
            .join(checked_broadcast(found, found.count()), F.col("__key").eqNullSafe(F.col("doc")), "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("__row", row_key("doc_id", "text"))
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), row_col="__row")


_W = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce({_W}, []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_W} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS t
  FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT rid, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS t
  FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, ns WHERE len(w) >= n)),
h AS (SELECT rid, i, dw.n AS n, item FROM dw JOIN bw ON dw.n = bw.n AND dw.t = bw.t),
c AS (SELECT rid, count(*) AS n_hit FROM (SELECT DISTINCT rid, unnest(generate_series(i, i + n - 1)) AS p FROM h) GROUP BY rid),
m AS (SELECT rid, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
 coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN m USING (rid)"""
