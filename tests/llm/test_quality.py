"""Bradley-Terry quality: features against plain Python, pairs, held-out accuracy, odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from riskframe.llm import quality as Q
from riskframe.llm.common import flat

SF = "/root/testdata/sf0.01"


def plain(text):
    """Features of one text, by name."""
    raw = (text or "").encode()
    words = [w for w in raw.translate(bytes.maketrans(bytes(range(9, 14)), b" " * 5)).split(b" ") if w]
    low = [w.lower() for w in words]  # bytes.lower changes A-Z only
    lines = [x for x in raw.lower().replace(b"\r", b"\n").split(b"\n") if x]
    out = {f"sign_{chr(b)}": raw.count(bytes([b])) for b in Q.SIGNS}
    out |= {"upper": sum(65 <= b < 91 for b in raw), "lower": sum(97 <= b < 123 for b in raw), "digit": sum(48 <= b < 58 for b in raw),
            "wide": sum(b > 127 for b in raw), "space": sum(b == 32 or 9 <= b < 14 for b in raw)}
    out["control"] = len(raw) - sum(out.values())
    out = {k: (v / max(len(raw), 1)) ** 0.5 for k, v in out.items()}
    n = max(len(words), 1)
    sign = lambda w: sum(b in Q.SIGNS for b in w)
    letters = lambda w: sum(65 <= b < 91 or 97 <= b < 123 or b > 127 for b in w)
    caps = lambda w: sum(65 <= b < 91 for b in w)
    out |= {"word_length": sum(map(len, words)) / n / 10, "long_words": sum(len(w) > 20 for w in words) / n,
            "signs_at_end": sum(w[-1] in Q.SIGNS for w in words) / n, "no_letters": sum(letters(w) == 0 for w in words) / n,
            "capitals": sum(letters(w) > 1 and caps(w) == letters(w) for w in words) / n,
            "same_as_before": sum(a == b for a, b in zip(low, low[1:])) / n, "seen_before": (len(low) - len(set(low))) / n,
            "signs_inside": sum(sign(w) > 1 for w in words) / n, "lines_seen": (len(lines) - len(set(lines))) / max(len(lines), 1),
            "line_words": np.log1p(len(words) / max(len(lines), 1)) / 5, "any_words": float(bool(words)), "log_words": np.log1p(len(words)) / 10}
    return [out[k] for k in Q.NAMES]


def test_features_against_plain_python():
    rng = random.Random(2)
    texts = ["", None, " ", "\n\n", "One two two TWO!! *** é\r\nsame line\nsame line\n12 34", "x" * 50, "\x00\x01 a"]
    texts += ["".join(rng.choice("ab AB.!\n\t9é日*") for _ in range(rng.randrange(80))) for _ in range(200)]
    got = Q.features(*flat(pa.array(texts, pa.string())))
    assert np.allclose(got, np.array([plain(t) for t in texts]), atol=1e-12)


def test_held_out_documents(spark):
    """Labels of held-out ids are not read; documents not learnt from are told apart."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in Q.quality(docs, labels).collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    held = [i for i in truth if i in got and got[i].held_out]
    assert len(held) > 50 and sum(got[i].predicted == truth[i] for i in held) >= 0.97 * len(held)
    lies = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    same = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    again = {r.doc_id: r.score for r in Q.quality(same, lies).collect()}
    assert all(abs(again[i] - r.score) < 1e-12 for i, r in got.items())


def test_pairs_meet_the_other_label(spark):
    known = spark.createDataFrame([(i, int(i % 4 == 0), [float(i)]) for i in range(40)], "doc_id long, good int, x array<double>")
    pairs = [(r.better[0], r.worse[0]) for r in Q.preference_pairs(known, 6).collect()]
    assert len(set(pairs)) == len(pairs) == 180 and all(a % 4 == 0 and b % 4 for a, b in pairs)
    assert {a for a, _ in pairs} == {float(i) for i in range(0, 40, 4)} and len({b for _, b in pairs}) == 30
    assert Q.preference_pairs(known.where("good = 1")).count() == 0


def test_odd_rows(spark):
    rng = random.Random(4)
    good = lambda: " ".join(rng.choice(["plain", "words", "of", "a", "text"]) + str(rng.randrange(9)) for _ in range(30))
    rows = [(i, good() if i % 2 else good().upper().replace(" ", "!! ")) for i in range(80)]
    odd = [(None, None), (None, ""), (7, None), (7, good()), (7, good()), (900, "X!! " * 200_000), (901, "")]
    docs = spark.createDataFrame([(a, b, 1.0, 2, "x") for a, b in rows + odd], "doc_id long, text string, score double, good int, h string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(1, 1), (3, None), (None, 0), (5000, 1)], "doc_id long, quality int")
    got = Q.quality(docs, labels).collect()
    assert len(got) == len(rows) + len(odd) and all(r.score is not None for r in got)
    assert sum(r.held_out for r in got if r.doc_id is None) == 0
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id is not None and r.doc_id < 80 and r.doc_id != 7)
    assert [r.predicted for r in got if r.doc_id == 900] == [0]
    assert Q.quality(docs.limit(0), labels).collect() == []
    for some, flag in ((labels.limit(0), 1), (labels.where("quality = 1"), 1), (labels.where("quality = 0"), 0)):  # one label or none
        assert {r.predicted for r in Q.quality(docs, some).collect()} == {flag}


def test_all_labelled_documents_are_fitted(spark):
    """A mark that only a few labelled documents beyond the first 8,000 by id hash show is learnt."""
    ids = spark.range(13_000).select(F.col("id").alias("doc_id"), F.xxhash64("id").alias("h")).where(~Q.held_out("doc_id"))
    order = [r.doc_id for r in ids.orderBy("h").collect()]
    late = set(order[8_000:])
    assert len(late) > 1_000
    rows = [(i, ("plain words ~ " if i in late and i % 2 == 0 else "plain words ") * (1 + i % 5)) for i in order]
    docs = spark.createDataFrame([*rows, (50_000, "plain ~ words"), (50_001, "plain words")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0 if i in late and i % 2 == 0 else 1) for i in order], "doc_id long, quality int")
    got = {r.doc_id: r for r in Q.quality(docs, labels).collect()}
    assert got[50_000].predicted == 0 and got[50_001].predicted == 1 and got[50_000].score < got[50_001].score


def test_quantile_is_exact(spark):
    rng = random.Random(6)
    for values in ([3.0], [1.0, 2.0], [5.0] * 50, [rng.gauss(0, 1) ** 9 for _ in range(3_000)] + [0.25] * 4_000 + [1e300, -1e300]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        for share in (0.0, 0.1, 1 / 3, 0.5, 0.93, 1.0):
            assert Q.quantile(df, F.col("v"), share) == df.agg(F.percentile("v", F.lit(share)).alias("p")).first().p
