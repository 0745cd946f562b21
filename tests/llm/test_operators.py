"""Operators against brute force on small tables, and their defined results for odd rows."""

import re
from collections import Counter, defaultdict
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import catalog, chat, decontam, embeddings, jaccard, mixing, pii, suffixes, toxicity, warc

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (5, "one two"), (None, "one two three four"), (6, "x" * 250), (7, "x" * 250),
       (8, "é１ mail a.b+c@d-e.org and 1.2.3.4 or 1.2.3.999, +49 (30) 123456, 4111 1111 1111 1111 end"), (9, "word " * 30000)]
SCHEMA = "doc_id long, text string"


def odd(spark, n=None):
    """Odd rows under extra columns whose names clash with those used inside."""
    df = spark.createDataFrame(ODD[:n] if n is not None else ODD, SCHEMA)
    return df.select("*", *[F.lit(7).alias(c) for c in ("id", "h", "t", "n", "doc", "key", "size", "words", "comp")], F.lit("s").alias("source"))


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = catalog.QUERIES[name](spark, SF)
    names = sorted(got.columns)
    text = lambda rows: sorted(tuple("" if x is None else f"{x:.6f}" if isinstance(x, float) else str(x) for x in r) for r in rows)
    assert text(tuple(r) for r in got.select(names).collect()) == text(con.sql(f"SELECT {', '.join(names)} FROM ({catalog.ORACLE[name]})").fetchall())


def roots(links, ids):
    par = {i: i for i in ids}

    def root(x):
        while par[x] != x:
            x = par[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        par[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("width,num", [(3, 90), (5, 80)])
def test_jaccard(spark, width, num):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    base = " ".join(f"w{i}" for i in range(60))
    rows += [(10**6 + i, base.replace(f"w{i} ", "other ")) for i in range(12)] + [(10**6 + 50, None), (10**6 + 51, " "), (10**6 + 52, "a b"), (10**6 + 53, "A B")]
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    at, links = defaultdict(list), []
    for i, s in sets.items():
        for j, k in Counter(j for x in s for j in at[x]).items():
            if 100 * k >= num * (len(s) + len(sets[j]) - k):
                links.append((i, j))
        for x in s:
            at[x].append(i)
    want = roots(links, sets)
    got = jaccard.jaccard_components(spark.createDataFrame(rows, SCHEMA), width=width, num=num).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), want[i]) for i in sets} and links


def test_suffixes(spark, monkeypatch):
    rows = [(r.doc_id, (r.text or "").encode()) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(10**6, b"a" * 777), (10**6 + 1, b"ab" * 500), (10**6 + 2, b"x" * 199), (10**6 + 3, b""), (10**6 + 4, "é".encode() * 150), (10**6 + 5, b"\0" * 300)]
    seen = Counter(b[s : s + 200] for _, b in rows for s in range(len(b) - 199))
    want = {}
    for i, b in rows:
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - 199):
            if seen[b[s : s + 200]] > 1:
                gone[s : s + 200] = True
        want[i] = (len(b), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), sha256(bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])).hexdigest())
    df = spark.createDataFrame([(i, b.decode()) for i, b in rows], SCHEMA)
    for hot in (suffixes.HOT, 1):  # the way for very common anchors gives the same
        monkeypatch.setattr(suffixes, "HOT", hot)
        assert {r[0]: tuple(r[1:5]) for r in suffixes.remove_repeats(df).collect()} == want


def test_vectors(spark):
    rng = np.random.default_rng(0)
    centre = rng.normal(size=(6, 16))
    v = [list(map(float, centre[i % 6] + rng.normal(size=16) * 0.25)) for i in range(400)]
    rows = list(enumerate(v)) + [(400, v[0]), (401, None), (402, [0.0] * 16), (403, [float("nan")] * 16), (404, [None] * 16), (405, [1.0, 2.0]), (406, [float("inf")] + [0.0] * 15)]
    good = np.array(v + [v[0]])
    good /= np.linalg.norm(good, axis=1, keepdims=True)
    near = good @ good.T >= 0.95
    want = roots([(a, b) for a, b in np.argwhere(near) if a < b], range(401))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert near.sum() > 1000
    assert sum(got[i][0] for i in range(401)) >= 0.99 * (near.sum() - 401) and all(got[i][0] <= near[i].sum() - 1 for i in range(401))
    assert [got[i][1] for i in range(401)] == [want[i] for i in range(401)]
    assert all(got[i] == (0, i, True) for i in range(401, 407))


def test_private(spark):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def fits(kind, m):
        digits = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.split(".")),
                "card": 16 <= len(digits) <= 19 and pii.luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]

    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("0123456789.@-+ ab()%é１"), rng.integers(0, 70))) for _ in range(20000)] + [t or "" for _, t in ODD]
    found = 0
    for t in texts:
        got = pii.find(t)
        for kind, p in patterns.items():
            want = [m.span() for m in re.finditer(p, t) if fits(kind, m[0])]
            assert got[kind] == want, (kind, t)
            found += len(want)
    assert found > 500 and pii.find("see https://a.example/x?y=1. account no: DE12-3456-7890 ok")["url"] == [(4, 27)]
    assert pii.find_private(odd(spark)).count() == len(ODD) and pii.find_private(odd(spark, 0)).count() == 0


def test_loser_tree_and_archives(spark):
    rng = np.random.default_rng(1)
    runs = [sorted(rng.integers(0, 50, rng.integers(0, 9)).tolist()) for _ in range(11)]
    assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)
    assert list(warc.LoserTree([], lambda x: x)) == []
    rows = [(1, "http://b.a/x", "same\r\n\r\nWARC/1.1\r\n"), (3, "http://a.a/", "same\r\n\r\nWARC/1.1\r\n"), (2, None, None), (4, "u\r\nX: y", ""), (None, "http://[bad", "ü" * 9), (5, "http://b.a/x", "z" * 10**6)]
    path = warc.shared_path(spark, "test")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    got = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in warc.read_archives(spark, path).collect()}
    assert got == {1: ("revisit", 3, 18), 3: ("response", None, 18), 2: ("revisit", 4, 0), 4: ("response", None, 0), None: ("response", None, 18), 5: ("response", None, 10**6)}


def test_chat_layouts(spark):
    df = spark.createDataFrame(
        [(1, [("human", "hi [INST]"), ("gpt", None)], None, None, None), (2, None, "do\\", "that", "done </s>"), (3, None, "do", None, "ok"), (4, None, None, None, None)],
        "k long, conversations array<struct<from:string,value:string>>, instruction string, input string, output string")
    turns = chat.canonical_turns(df, "k", fields=["conversations", "instruction", "input", "output"])
    assert {(r.conv, r.layout) for r in turns.collect()} == {(1, "shares"), (2, "instruction"), (3, "instruction"), (4, "unknown")}
    back = chat.format_chats(turns).select("conv", chat.read_chats(F.col("formatted")).alias("t"), chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("m"))
    got = {r.conv: ([tuple(x) for x in r.t], r.m) for r in back.collect()}
    assert got == {1: ([("user", "hi [INST]"), ("assistant", "")], ""), 2: ([("user", "do\\\n\nthat"), ("assistant", "done </s>")], "done </s>"),
                   3: ([("user", "do"), ("assistant", "ok")], "ok"), 4: ([("", "")], "")}


def test_toxicity_held_out(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    chain = toxicity.train(docs, labels.where("doc_id % 2 = 0"))
    rows = toxicity.score(docs, chain).join(labels.where("doc_id % 2 = 1"), "doc_id").select("toxic", "p_toxic").collect()
    hit = np.array([(r.toxic, r.p_toxic > 0.5) for r in rows])
    assert hit[hit[:, 0] == 1, 1].mean() > 0.85 and hit[hit[:, 0] == 0, 1].mean() < 0.02
    empty = toxicity.toxicity(odd(spark), labels.where("false"))
    assert empty.where("toxic").isEmpty() and empty.count() == len(ODD)


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, "one two"), (2, None), (3, "")], "item_id long, text string")
    got = [tuple(r)[:4] for r in decontam.decontaminate(odd(spark), items).orderBy("doc_id").collect()]
    assert (5, 2, 2, 1) in got and (None, 4, 2, 1) in got and (1, 0, 0, 0) in got and len(got) == len(ODD)
    mixed = mixing.mix_sources(odd(spark), "doc_id", "source", mixing.n_words(F.col("text"))).collect()
    total = sum(r.size for r in mixed)
    assert len(mixed) == len(ODD) and all(r.target == pytest.approx(1.5 * total) and r.taken <= 2 * r.size for r in mixed)
    for f in (jaccard.jaccard_components, suffixes.remove_repeats):
        assert f(odd(spark)).count() == len(ODD) and f(odd(spark, 0)).count() == 0
    assert mixing.mix_sources(odd(spark, 0), "doc_id", "source", mixing.n_words(F.col("text"))).count() == 0
    assert decontam.decontaminate(odd(spark, 0), items).count() == 0


@pytest.mark.parametrize("num", [80, 90])
def test_similar_sets_share_a_block(num):
    rng = np.random.default_rng(num)
    for n in [*range(1, 40), 100, 333, 1000, 3000, 9000]:
        for _ in range(3):
            whole = rng.integers(0, 2**64, n, dtype=np.uint64)
            gone = n * (100 - num) // 100
            a, b = np.unique(whole), np.unique(whole[gone:])  # the largest difference that still links
            if len(b) < len(a):
                assert np.intersect1d(jaccard.block_keys(a, num, 100), jaccard.block_keys(b, num, 100)).size
            half = gone // 2
            c = np.unique(np.concatenate((whole[half:], rng.integers(0, 2**64, half, dtype=np.uint64))))
            if half and 100 * len(np.intersect1d(a, c)) >= num * len(np.union1d(a, c)):
                assert np.intersect1d(jaccard.block_keys(a, num, 100), jaccard.block_keys(c, num, 100)).size


def test_long_sketch_folds_and_bounds_the_difference():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**64, 2100, dtype=np.uint64)
    b = a[200:]  # sketches of 4096 and 2048 bits
    x, y = jaccard.long_sketch(a), jaccard.long_sketch(b)
    assert len(x) == 2 * len(y) == 64
    folded = x[:32] ^ x[32:]
    assert np.bitwise_count(folded ^ y).sum() <= 200
    assert len(jaccard.long_sketch(a[:1500])) == 0
