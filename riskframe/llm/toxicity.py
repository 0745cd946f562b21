"""Toxicity by a classifier chain of linear models.

Categories are predicted one after another; the model of a category sees the words of a text and the log-odds of all
earlier categories.  In training those come from out-of-fold predictions, so a later model learns from what an earlier
one says about texts it has not seen.  Words are hashed; their presence is scaled by the smoothed log-ratio of their
frequencies in the two classes before the logistic fit.

The fit uses at most ``max_rows`` labelled documents, those of smallest id hash (a documented bound); scoring covers all
documents whole, one map without a shuffle, with a model of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import LOWER, RollingHash, checked_broadcast, flat, steps, table, words
from riskframe.session import ship_package

MAX_TRAIN_ROWS = 8_000
HASH_BITS = 18
FOLDS = 3
MIN_Z = 3.0
# A word counts by itself and by its first bytes, so that inflected forms of one stem share features.
STEMS = (4, 5)
CATEGORIES = ("low_quality", "toxic")
# Letters, digits and bytes beyond ASCII make up a feature word.
BREAKS = np.ones(256, bool)
BREAKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_HASH = RollingHash(61)


def _features(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, hashed distinct words and stems, offsets of the rows) in steps of bounded size."""
    for i, j in steps(off):
        part, cut = LOWER[data[off[i] : off[j]]], off[i : j + 1] - off[i]
        start, end, woff = words(part, cut, BREAKS)
        _HASH.load(part)
        row = np.repeat(np.arange(j - i, dtype=np.int64) << HASH_BITS, np.diff(woff))
        ends = (end, *(np.minimum(end, start + n) for n in STEMS))
        pairs = np.unique(np.concatenate([row | (_HASH.at(start, e) >> np.uint64(64 - HASH_BITS)).astype(np.int64) for e in ends]))
        yield i, j, pairs & ((1 << HASH_BITS) - 1), np.searchsorted(pairs, np.arange(j - i + 1, dtype=np.int64) << HASH_BITS)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Text column -> list of hashed distinct words; other columns pass."""
    for b in batches:
        data, off = flat(b.column("text"))
        for i, j, codes, at in _features(data, off):
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(codes, pa.int32()))
            yield pa.RecordBatch.from_arrays([*(b.column(c).slice(i, j - i) for c in b.schema.names if c != "text"), lists],
                                             names=[*(c for c in b.schema.names if c != "text"), "codes"])


@dataclass
class Linear:
    """Weights by word code, one per earlier category, and the intercept."""

    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def odds(self, codes: np.ndarray, at: np.ndarray, before: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0.0], np.cumsum(self.weights[codes])))
        return sums[at[1:]] - sums[at[:-1]] + before @ self.earlier + self.bias


def fit_linear(codes: np.ndarray, at: np.ndarray, before: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 60) -> Linear:
    """Logistic regression by accelerated gradient steps; a single class gives a constant model."""
    n, k = len(y), before.shape[1]
    size = 1 << HASH_BITS
    pos = float(y.sum())
    prior = float(np.log((pos + 0.5) / (n - pos + 0.5)))
    if pos in (0.0, float(n)):  # also without rows
        return Linear(np.zeros(size), np.zeros(k), prior)
    row = np.repeat(np.arange(n, dtype=np.int32), np.diff(at))
    in_pos = np.repeat(y > 0, np.diff(at))
    p = np.bincount(codes[in_pos], minlength=size).astype(float)
    q = np.bincount(codes[~in_pos], minlength=size).astype(float)
    ratio = np.log((p + 0.5) / (pos + 1)) - np.log((q + 0.5) / (n - pos + 1))
    # Words whose frequency differs between the classes by less than MIN_Z standard errors are left out.
    share = (p + q) / n
    z = np.abs(p / pos - q / (n - pos)) / np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / pos + 1 / (n - pos)))
    ratio[(z < MIN_Z) | (p + q < 3)] = 0.0
    keep = ratio[codes] != 0
    row, used = row[keep], codes[keep]
    live, col = np.unique(used, return_inverse=True)
    val = ratio[used]
    w, u, b = np.zeros(len(live)), np.zeros(k), prior
    # Step from the largest row norm bounds the curvature of the loss.
    scale = np.bincount(row, weights=val * val, minlength=n) + (before**2).sum(axis=1) + 1
    step = 4.0 / (np.mean(scale) * n / 4 + ridge)
    vw, vu, vb, t = w, u, b, 1.0
    best = np.inf

    def loss_grad(w, u, b):
        z = np.bincount(row, weights=val * w[col], minlength=n) + before @ u + b
        e = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
        loss = np.logaddexp(0, z).sum() - (y * z).sum() + ridge / 2 * (w @ w)
        return loss, np.bincount(col, weights=val * e[row], minlength=len(w)) + ridge * w, before.T @ e, e.sum()

    for _ in range(rounds):
        loss, gw, gu, gb = loss_grad(vw, vu, vb)
        while True:
            nw, nu, nb = vw - step * gw, vu - step * gu, vb - step * gb
            new = loss_grad(nw, nu, nb)[0]
            if new <= loss - step / 2 * (gw @ gw + gu @ gu + gb * gb) * 0.5 or step < 1e-12:
                break
            step /= 2
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if new > best:
            nt = 1.0
        vw, vu, vb = nw + (t - 1) / nt * (nw - w), nu + (t - 1) / nt * (nu - u), nb + (t - 1) / nt * (nb - b)
        if best - new < 1e-6 * abs(new) and new <= best:
            w, u, b = nw, nu, nb
            break
        w, u, b, t, best = nw, nu, nb, nt, min(best, new)
    full = np.zeros(size)
    full[live] = w * ratio[live]
    return Linear(full, u, float(b))


def fit_chain(codes: np.ndarray, at: np.ndarray, fold: np.ndarray, labels: np.ndarray) -> list[Linear]:
    """One model per column of ``labels``; earlier categories enter as out-of-fold log-odds."""

    def rows(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = np.diff(at)
        return codes[np.repeat(mask, size)], np.concatenate(([0], np.cumsum(size[mask])))

    before, chain = np.zeros((len(at) - 1, 0)), []
    for c in range(labels.shape[1]):
        y = labels[:, c]
        out = np.zeros(len(y))
        for f in range(FOLDS):
            test = fold == f
            model = fit_linear(*rows(~test), before[~test], y[~test])
            out[test] = model.odds(*rows(test), before[test])
        chain.append(fit_linear(codes, at, before, y))
        before = np.column_stack([before, np.clip(out, -20, 20)])
    return chain


def score_chain(chain: Sequence[Linear], codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    before = np.zeros((len(at) - 1, 0))
    for model in chain:
        before = np.column_stack([before, np.clip(model.odds(codes, at, before), -20, 20)])
    return 1 / (1 + np.exp(-before))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> list[Linear]:
    """Fit the chain on ``labels(doc_id, quality, toxic)``; rows with a null in either label or id are not used.

    A document labelled several times counts as positive if one row says so; without labelled documents
    all models are constant at odds of 1 to 1 or less and no document is called toxic.
    """
    spark = docs.sparkSession
    ship_package(spark)
    picked = (labels.where("doc_id is not null and quality is not null and toxic is not null")
              .groupBy("doc_id").agg((1 - F.min("quality")).alias("low_quality"), F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    known = (docs.select(F.col("doc_id").alias("id"), "text").join(checked_broadcast(picked, max_rows), F.col("id") == F.col("doc_id"))
             .select("doc_id", "low_quality", "toxic", "text"))
    encoded = known.mapInArrow(_encode, "doc_id long, low_quality int, toxic int, codes array<int>")
    # At most max_rows lists of distinct word codes: a bounded sample.
    rows = encoded.orderBy("doc_id").limit(max_rows).toArrow().combine_chunks()
    lists = rows.column("codes").combine_chunks() if rows.num_rows else pa.array([], pa.list_(pa.int32()))
    codes = lists.flatten().to_numpy(zero_copy_only=False)
    at = np.concatenate(([0], np.cumsum([len(x) for x in lists], dtype=np.int64))).astype(np.int64)
    y = np.column_stack([rows.column(c).to_numpy() for c in CATEGORIES]).astype(float) if rows.num_rows else np.zeros((0, len(CATEGORIES)))
    return fit_chain(codes, at, np.arange(len(y)) % FOLDS, y)


def score(docs: DataFrame, chain: Sequence[Linear]) -> DataFrame:
    """All columns of ``docs`` except ``text`` are dropped but ``doc_id``: ``(doc_id, p_low_quality, p_toxic)`` per row, null text as empty."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast([(m.weights.astype(np.float32), m.earlier, m.bias) for m in chain])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = [Linear(w, u, b) for w, u, b in model.value]
        for batch in batches:
            data, off = flat(batch.column("text"))
            p = np.zeros((batch.num_rows, len(models)))
            for i, j, codes, at in _features(data, off):
                p[i:j] = score_chain(models, codes, at)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(p[:, c]) for c in range(p.shape[1]))],
                                             names=["doc_id", *(f"p_{c}" for c in CATEGORIES)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, " + ", ".join(f"p_{c} double" for c in CATEGORIES))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """``(doc_id, p_low_quality, p_toxic, toxic)`` per row of ``docs``."""
    return score(docs, train(docs, labels, max_rows)).withColumn("toxic", F.col("p_toxic") > threshold)


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the documents called toxic, all columns kept.  Every row is scored by its own text."""
    chain = train(docs, labels)
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast([(m.weights.astype(np.float32), m.earlier, m.bias) for m in chain])
    at_text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = [Linear(w, u, b) for w, u, b in model.value]
        for batch in batches:
            data, off = flat(batch.column(at_text))
            clean = np.ones(batch.num_rows, bool)
            for i, j, codes, at in _features(data, off):
                clean[i:j] = score_chain(models, codes, at)[:, -1] <= threshold
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
