"""Words of decontamination: A-Z alone are lower-cased, and whole texts do not go through ``translate``."""

import re

from pyspark.sql import functions as F

from riskframe.llm import decontam

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = [None, "", " .,", "One TWO_three 4x", "ÉCOLE Été École ça", "Kelvin K İstanbul ΣΑΣ Ⅷ Straße ẞ", "a\u0000B\u007Fc\u0080D\nE", "日本Go語 GO", "Z{z}[Q]`q`@A"]


def test_words_like_the_rule(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    got = df.select("i", decontam.bench_words(F.col("text")).alias("w"), decontam.n_bench_words(F.col("text")).alias("n")).orderBy("i").collect()
    for i, w, n in got:
        want = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (TEXTS[i] or "").translate(AZ))
        assert w == want and n == len(want)


def test_texts_are_not_translated_whole(spark):
    """``translate`` took most of the time of the query: a map lookup per character, twice per text."""
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    items = spark.createDataFrame([("a", "x y")], "item_id string, text string")
    out = decontam.decontaminate(docs, items)
    plan = docs.select(decontam.bench_words(F.col("text")))._jdf.queryExecution().optimizedPlan().toString() + out._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(text#" not in plan
