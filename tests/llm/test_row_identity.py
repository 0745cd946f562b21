"""Rows of null and repeated ids in the mix and in decontamination, merged order of archives, fields that no layout knows."""

import json
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from riskframe.llm import chat, decontam, mixing, warc

DOCS = ([(None, "same words in every row of these", "a")] * 90 + [(None, f"other row {i} of no name " * (i % 5), "a") for i in range(30)]
        + [(i // 3, f"row {i} one two three four five six seven", "b" if i % 2 else None) for i in range(40)]
        + [(None, None, "c"), (5, "", "c"), (5, "", "c"), (7, "a long " * 400, "d"), (7, "short", "d")])


def frames(spark, tmp_path, **tables):
    con = duckdb.connect()
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/part-*')")
    return con


def same(spark, con, query, sql, path):
    got = query(spark, str(path))
    cols = sorted(got.columns)
    mine = Counter(tuple(r[c] for c in cols) for r in got.collect())
    assert mine == Counter(con.sql(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall())
    return got


def test_mix_takes_rows_one_by_one(spark, tmp_path):
    con = frames(spark, tmp_path, documents=(DOCS, "doc_id long, text string, source string"))
    rows = same(spark, con, mixing.op1_mix_sources, mixing.oracle(), tmp_path).collect()
    for source in {r.source for r in rows}:
        mine = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r.size for r in mine) / 2
    assert len({r.copies for r in rows if r.doc_id is None and r.source == "a" and r.size == 7}) == 2  # equal rows are parted


def test_decontamination_judges_each_row(spark, tmp_path):
    leak = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    docs = [(None, "clean text of no name", "a"), (None, "x " + leak + " y", "a"), (4, leak, "b"), (4, "another clean one", "b"), (4, leak, "b"), (None, None, "c"), (9, "few words", "c")]
    con = frames(spark, tmp_path, documents=(docs, "doc_id long, text string, source string"),
                 benchmark=([(1, leak), (2, "few words"), (3, None), (1, "")], "item_id long, text string"))
    rows = same(spark, con, decontam.op9_decontaminate, decontam.ORACLE, tmp_path).collect()
    assert sorted((r.n_words, r.n_hit) for r in rows) == [(0, 0), (2, 2), (3, 0), (5, 0), (11, 11), (11, 11), (13, 11)]


def test_captures_come_in_order_without_broadcasts(spark):
    rows = [(i, f"http://h{i % 7}.example/p{i % 11}", "same page" if i % 3 else f"page {i}") for i in range(600)]
    path = warc.shared_path(spark, "order")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5), path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = [(r.urlkey, r.captured, r.page_id) for r in warc.read_archives(spark, path).collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(got) == 600 and got == sorted(got)


def test_fields_beside_a_layout_lose_nothing(spark):
    message = "array<struct<role:string,content:string,name:string>>"
    rows = [(1, [("user", "hi", "Ann"), ("assistant", "yo", None)], "en", None), (2, [("user", "a", None)], None, "both?"), (3, None, "xx", None), (4, None, None, "only a prompt")]
    df = spark.createDataFrame(rows, f"k long, messages {message}, lang string, prompt string")
    got = {}
    for r in chat.canonical_turns(df, "k").orderBy("k", "pos").collect():
        got.setdefault(r.conv, []).append((r.layout, r.role, r.text))
    assert got[1] == [("messages", "user", "hi"), ("messages", "assistant", "yo")] and got[4] == [("prompt", "user", "only a prompt")]
    ((layout, role, text),) = got[2]
    assert (layout, role) == ("unknown", None) and json.loads(text) == {"messages": [{"role": "user", "content": "a"}], "prompt": "both?"}
    assert [x[:2] for x in got[3]] == [("unknown", None)] and json.loads(got[3][0][2]) == {"lang": "xx"}
    assert chat.canonical_turns(df.limit(0), "k").collect() == []


@pytest.mark.parametrize("n", [0, 1])
def test_mix_of_few_rows(spark, n):
    docs = spark.createDataFrame([(None, "one two", None)][:n], "doc_id long, text string, source string")
    rows = mixing.mix_sources(docs, "doc_id", "source", mixing.n_words(F.col("text"))).collect()
    assert [(r.size, r.target) for r in rows] == [(2, 3.0)][:n] and all(r.taken in (2, 4) for r in rows)
