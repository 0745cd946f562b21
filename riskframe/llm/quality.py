"""Document quality by Bradley-Terry pairwise ranking.

A document is a short vector of shape features of its whole text (shares of character classes, repeats of words and lines, lengths).
Preference pairs set a document labelled good against one labelled bad; the chance that the first is preferred is
the logistic function of the weighted feature difference, so the weights come from a logistic fit without intercept on differences.
A document's strength is its weighted feature sum.  The cut is a quantile of the strengths of the fitted
documents, the one with as many below it as are labelled bad; the score is the chance to be preferred to a document at the
cut, moved so that the cut scores ``CUT``.

Every text is read whole, once: its features are stored and serve the fit, the cut and the scores.  The fit uses every labelled
document outside the held-out fold and runs as a Spark job over the pairs; the cut is the exact quantile of all their strengths.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import LOWER, SPACE, RollingHash, discard, flat, staged, steps, table, words
from riskframe.operators.rank import ordered_row_number
from riskframe.session import ship_package

# Pairs per document of the more frequent label.
PARTNERS = 8
RIDGE = 1e-3
CUT = 0.3
FOLDS, HELD_OUT = 5, 0
# Parts of the value range that one pass of the quantile counts.
SLICES = 4096
_HASH = RollingHash(151)

# Character classes: each ASCII sign that is neither letter nor digit, then the classes below.
SIGNS = [b for b in range(33, 127) if not chr(b).isalnum()]
CLASSES = len(SIGNS) + 6
KIND = np.full(256, len(SIGNS) + 5, np.uint8)  # control bytes
KIND[SIGNS] = np.arange(len(SIGNS))
KIND[65:91], KIND[97:123], KIND[48:58] = (len(SIGNS) + k for k in range(3))
KIND[128:] = len(SIGNS) + 3
KIND[SPACE] = len(SIGNS) + 4
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
LINE_END = np.zeros(256, bool)
LINE_END[[0x0A, 0x0D]] = True
NAMES = [*(f"sign_{chr(b)}" for b in SIGNS), "upper", "lower", "digit", "wide", "space", "control",
         "word_length", "long_words", "signs_at_end", "no_letters", "capitals", "same_as_before", "seen_before", "signs_inside",
         "lines_seen", "line_words", "any_words", "log_words"]


def _share(part: np.ndarray, of: np.ndarray) -> np.ndarray:
    return part / np.maximum(of, 1)


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Feature rows of the texts ``data[off[i]:off[i + 1]]``; an empty text has all zeros."""
    n, size = len(off) - 1, np.diff(off)
    row = np.repeat(np.arange(n), size)
    chars = np.bincount(row * CLASSES + KIND[data], minlength=n * CLASSES).reshape(n, CLASSES)
    start, end, at = words(data, off, SPACE)
    count = np.diff(at)
    of = np.repeat(np.arange(n), count)
    per_row = lambda flag: np.bincount(of, weights=flag, minlength=n)

    def inside(mask: np.ndarray) -> np.ndarray:
        """How many bytes of each word are in ``mask``."""
        total = np.concatenate(([0], np.cumsum(mask[data])))
        return total[end] - total[start]

    def repeats(s: np.ndarray, e: np.ndarray, r: np.ndarray) -> np.ndarray:
        """Per row, how many of the byte ranges equal an earlier one of the row."""
        pairs = np.unique(np.stack([r.astype(np.uint64), _HASH.at(s, e)], axis=1), axis=0)[:, 0] if len(s) else np.zeros(0, np.uint64)
        return np.bincount(r, minlength=n) - np.bincount(pairs.astype(np.int64), minlength=n)

    lower = LOWER[data]
    _HASH.load(lower)
    length, letters = end - start, inside(LETTER)
    upper, sign = inside(KIND == len(SIGNS)), inside(KIND < len(SIGNS))
    code = _HASH.at(start, end)
    same = np.zeros(len(start), bool)
    same[1:] = (code[1:] == code[:-1]) & (of[1:] == of[:-1])
    last = KIND[data[end - 1]] < len(SIGNS) if len(end) else np.zeros(0, bool)
    ls, le, lat = words(data, off, LINE_END)
    lines = np.diff(lat)
    w = [_share(per_row(length), count) / 10, _share(per_row(length > 20), count), _share(per_row(last), count),
         _share(per_row(letters == 0), count), _share(per_row((upper == letters) & (letters > 1)), count), _share(per_row(same), count),
         _share(repeats(start, end, of), count), _share(per_row(sign > 1), count),
         _share(repeats(ls, le, np.repeat(np.arange(n), lines)), lines), np.log1p(_share(count, lines)) / 5,
         (count > 0).astype(float), np.log1p(count) / 10]
    return np.column_stack([np.sqrt(chars / np.maximum(size, 1)[:, None]), *w])


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Column ``text`` -> ``x``, its features; other columns pass."""
    for b in batches:
        data, off = flat(b.column("text"))
        rest = [c for c in b.schema.names if c != "text"]
        for i, j in steps(off):
            x = features(data[off[i] : off[j]], off[i : j + 1] - off[i])
            lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, j - i) for c in rest), lists], names=[*rest, "x"])


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id as text leaves ``HELD_OUT`` when divided by ``FOLDS``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def preference_pairs(known: DataFrame, partners: int = PARTNERS) -> DataFrame:
    """``(better, worse)`` features: every document of ``known(doc_id, good, x)`` meets ``partners`` or more of the other label.

    Pair t sets good document t mod g against bad document (t + t div g) mod b, each label in the order of its id hashes.
    """
    counts = {r["good"]: r["count"] for r in known.groupBy("good").count().collect()}
    g, b = counts.get(1, 0), counts.get(0, 0)
    if not g or not b:
        return known.sparkSession.createDataFrame([], "better array<double>, worse array<double>")
    ranked = ordered_row_number(known.withColumn("h", F.xxhash64("doc_id")), ["good"], "h", "at").withColumn("at", F.col("at").cast("long") - 1)
    side = lambda good, at, name: ranked.where(F.col("good") == good).select(F.col("at").alias(at), F.col("x").alias(name))
    pairs = known.sparkSession.range(max(g, b) * min(partners, min(g, b))).selectExpr(f"id % {g} as p", f"(id + id div {g}) % {b} as q")
    return pairs.join(side(1, "p", "better"), "p").join(side(0, "q", "worse"), "q").select("better", "worse")


def quantile(rows: DataFrame, value: Column, share: float) -> float:
    """The exact quantile, interpolated as by ``percentile``, of a column without nulls.

    Each pass counts the values by slices of the range that is left and goes on with the slice of the two ranks asked for.
    """
    rows = rows.select(value.alias("v"))
    whole = rows.agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    at = (whole["n"] - 1) * share
    low, high, before, lo, hi = math.floor(at), math.ceil(at), 0, whole["lo"], whole["hi"]
    while lo < hi:
        part = F.least(F.floor((F.col("v") - lo) / (hi - lo) * SLICES), F.lit(SLICES - 1))
        slices = (rows.where(F.col("v").between(lo, hi)).groupBy(part.alias("part"))
                  .agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("part").collect())
        ends = np.cumsum([r["n"] for r in slices]) + before
        i, j = (int(np.searchsorted(ends, k, side="right")) for k in (low, high))
        if i != j:  # neighbours in rank: the last value of one slice, the first of the next
            return (high - at) * slices[i]["hi"] + (at - low) * slices[j]["lo"]
        before, lo, hi = int(ends[i]) - slices[i]["n"], slices[i]["lo"], slices[i]["hi"]
    return lo


def document_features(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, h, x)`` per row of ``docs``, stored: the hash and the features of its text."""
    ship_package(docs.sparkSession)
    rows = docs.select("doc_id", held_out("doc_id").alias("held_out"), F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", "held_out", F.xxhash64("text").alias("h"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return staged(rows.mapInArrow(_encode, f"doc_id {kind}, held_out boolean, h long, x array<double>"), "quality-features")


def train(found: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """Weights and cut from ``document_features`` and ``labels(doc_id, quality)``, held-out ids and rows with a null left aside.

    A document labelled several times is good only if all rows say so; of several texts of one id the one of smallest hash is used.
    Without both labels the weights are zero; all documents then score ``CUT``, or less if all labelled ones are bad.
    """
    marks = (labels.where("doc_id is not null and quality is not null").where(~held_out("doc_id"))
             .groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("good")))
    known = staged(found.where("not held_out").join(marks, "doc_id")
                   .groupBy("doc_id").agg(F.min(F.struct("h", "good", "x")).alias("k")).select("doc_id", "k.good", "k.x"), "quality-known")
    d = len(NAMES)
    seen = known.agg(F.count("*").alias("n"), F.sum("good").alias("g")).first()
    if not seen["n"] or seen["g"] in (0, seen["n"]):
        return np.zeros(d), 1.0 if seen["n"] and not seen["g"] else 0.0
    spread = known.agg(*[F.stddev_pop(F.get("x", F.lit(k))).alias(f"s{k}") for k in range(d)]).first()
    scale = np.array([1 / s if s and s > 1e-9 else 0.0 for s in spread])
    diff = F.zip_with("better", "worse", lambda p, q: p - q)
    diff = F.zip_with(diff, F.array(*[F.lit(float(s)) for s in scale]), lambda v, s: v * s)
    pairs = preference_pairs(known).select(diff.alias("v"), (F.pmod(F.xxhash64("better", "worse"), F.lit(2))).alias("turn"))
    # Every other pair is turned round, so that the fit sees both outcomes.
    pairs = staged(pairs.select(F.transform("v", lambda x: F.when(F.col("turn") == 1, -x).otherwise(x)).alias("v"), (1.0 - F.col("turn")).alias("label")), "quality-pairs")
    fit = LogisticRegression(featuresCol="v", labelCol="label", fitIntercept=False, standardization=False, regParam=RIDGE, maxIter=100)
    weights = fit.fit(pairs.select(array_to_vector("v").alias("v"), "label")).coefficients.toArray() * scale
    discard(pairs)
    strength = F.aggregate(F.zip_with("x", F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b), F.lit(0.0), lambda s, t: s + t)
    cut = quantile(known, strength, 1 - seen["g"] / seen["n"])
    discard(known)
    return weights, float(cut)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs(doc_id, text)``, each by its own text whatever its id.

    ``score`` is the chance of being preferred, ``CUT`` at the quantile that parts good from bad; null and empty texts have all
    features zero and are scored like any other.  Only the text enters the score: other columns are ignored.
    """
    found = document_features(docs)
    weights, cut = train(found, labels)
    shift = math.log(CUT / (1 - CUT)) - cut

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = b.column("x").flatten().to_numpy().reshape(-1, len(NAMES)) @ weights
            score = 1 / (1 + np.exp(-np.clip(score + shift, -700, 700)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(score), pa.array((score >= CUT).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.select("doc_id", "held_out", "x").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
