"""N-gram Jaccard join by parity sketches.

The tokens (word shingles) of a document flip bits of a sketch, so the Hamming distance of two sketches never exceeds the size of
their symmetric difference.  Sets of Jaccard similarity t or more differ in at most d = (1 - t) / (1 + t) * (|A| + |B|)
tokens; documents are grouped into bands of set size, and in a band with largest size m the sketch has
b > d(m) blocks of 2^20 bits, each known by the XOR of the hashes of its set bits.  By the pigeonhole two similar documents agree
in at least b - d(m) blocks and meet on the key (band, block, XOR).  Empty blocks agree by chance, so a document with fewer than
b - d(m) of them leaves them out: a similar one then still shares a block with set bits.  Candidates are compared by fixed
sketches, those of long documents also by sketches that grow with the set, and verified on the exact sets.

Documents of equal sets collapse first; a set is known by a 64-bit hash of its members and its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import LOWER, RollingHash, checked_broadcast, flat, mix, staged, steps, table, words
from riskframe.llm.components import link_buckets
from riskframe.session import ship_package

BAND_GROWTH = 1.5
# A fixed sketch of so many 64-bit words compares two candidates before their sets are read.
FOLD = 16
# Sets above this size saturate it and get a second sketch of about one bit per token.
LONG_SET = 1500
BLOCK_BITS = 20
_HASH = RollingHash(23)


@cache
def band_starts() -> np.ndarray:
    """Smallest set size of each band."""
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(max(edges[-1] + 1, int(edges[-1] * BAND_GROWTH)))
    return np.array(edges, np.int64)


def shingle_sets(data: np.ndarray, off: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every row, in steps of bounded size."""
    for i, j in steps(off):
        part, cut = LOWER[data[off[i] : off[j]]], off[i : j + 1] - off[i]
        start, end, at = words(part, cut)
        _HASH.load(part)
        w = _HASH.at(start, end)
        with np.errstate(over="ignore"):
            roll = np.zeros(max(len(w) - width + 1, 0), np.uint64)
            for k in range(width):
                roll = mix(roll * np.uint64(0x9E3779B97F4A7C15) + w[k : k + len(roll)])
            for r in range(j - i):
                a, b = at[r], at[r + 1]
                if b - a >= width:
                    yield i + r, np.unique(roll[a : b - width + 1])
                elif b > a:  # fewer words than a shingle: the whole sequence is one
                    x = np.uint64(b - a)
                    for h in w[a:b]:
                        x = mix(np.array([x * np.uint64(0x9E3779B97F4A7C15) + h]))[0]
                    yield i + r, np.array([x], np.uint64)
                else:
                    yield i + r, np.zeros(0, np.uint64)


def set_id(tokens: np.ndarray) -> np.uint64:
    with np.errstate(over="ignore"):
        return mix(np.array([tokens.sum() + np.uint64(len(tokens))], np.uint64))[0]


def sketch(tokens: np.ndarray, words: int) -> np.ndarray:
    """Parity sketch of ``64 * words`` bits: each token flips one of them.  With powers of two the upper half of a sketch
    XORed onto its lower half is the sketch of half the size."""
    bit = (tokens % np.uint64(64 * words)).astype(np.int64)
    odd = np.bincount(bit, minlength=64 * words).astype(np.uint8) & 1
    return np.packbits(odd).view(">u8").astype(np.uint64)


def long_sketch(tokens: np.ndarray) -> np.ndarray:
    """Sketch of a long set, a power of two of words; empty for others, which the fixed sketch tells apart."""
    if len(tokens) <= LONG_SET:
        return np.zeros(0, np.uint64)
    return sketch(tokens >> np.uint64(3) ^ tokens << np.uint64(61), 1 << int(len(tokens) - 1).bit_length() - 6)


@cache
def blocks_of(band: int, num: int, den: int) -> tuple[int, int]:
    """(largest difference d of two similar sets of the band, number of blocks): d + 1 and as many as its smallest
    sets are likely to leave empty."""
    smallest, largest = -(-int(band_starts()[band]) * num // den), int(band_starts()[band + 1]) - 1
    d = 2 * largest * (den - num) // (den + num)
    b = d + 1
    for _ in range(30):
        b = min(d + 1 + int(1.1 * b * np.exp(-smallest / b)), 2 * d + 1)
    return d, b


def block_keys(tokens: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of a set for similarity num / den: one per block of its own band, and of each higher band it could reach into."""
    n, starts = len(tokens), band_starts()
    own = int(np.searchsorted(starts, n, side="right")) - 1
    bits = mix(tokens >> np.uint64(64 - BLOCK_BITS))
    out = []
    band = own
    while band == own or starts[band] * num <= n * den:
        d, b = blocks_of(band, num, den)
        if d:  # else only equal sets are similar enough
            at = (tokens % np.uint64(b)).astype(np.int64)
            block = np.zeros(b, np.uint64)
            np.bitwise_xor.at(block, at, bits)
            with np.errstate(over="ignore"):
                keys = mix(mix(block + np.uint64(band << 32)) + np.arange(b, dtype=np.uint64))
            empty = block == 0
            out.append(keys[~empty] if np.count_nonzero(empty) < b - d else keys)
        band += 1
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _signatures(width: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = flat(batch.column("text"))
            rows, done = [], 0

            def give():
                part = batch.column("id").slice(done, len(rows))
                at = np.concatenate(([0], np.cumsum([len(r[2]) for r in rows])))
                keys = np.concatenate([r[2] for r in rows]).view(np.int64)
                folds = np.array([r[3] for r in rows]).view(np.int64)
                far = np.concatenate(([0], np.cumsum([len(r[4]) for r in rows])))
                wide = np.concatenate([r[4] for r in rows]).view(np.int64)
                return pa.RecordBatch.from_arrays(
                    [part, pa.array([r[0] for r in rows], pa.int64()), pa.array(np.array([r[1] for r in rows], np.uint64).view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(keys)),
                     pa.ListArray.from_arrays(pa.array(far, pa.int32()), pa.array(wide)), *(pa.array(folds[:, k]) for k in range(FOLD))],
                    names=["doc", "n", "id", "keys", "wide", *(f"s{k}" for k in range(FOLD))])

            size = 0
            for _, tokens in shingle_sets(data, off, width):
                digest = set_id(tokens)
                keys = block_keys(tokens, num, den) if len(tokens) else np.zeros(0, np.uint64)
                rows.append((len(tokens), digest, keys, sketch(tokens >> np.uint64(3) ^ tokens << np.uint64(61), FOLD), long_sketch(tokens)))
                size += len(keys) + len(rows[-1][4])
                if len(rows) == 500 or size > 1 << 18:
                    yield give()
                    done += len(rows)
                    rows, size = [], 0
            if rows:
                yield give()

    return run


def _folded(x: str, other: str) -> str:
    """SQL: sketch ``x``, folded once if it is longer than ``other`` (sizes of similar sets are at most one power of two apart)."""
    half = f"cast(size({x}) / 2 as int)"
    return f"if(size({x}) > size({other}), zip_with(slice({x}, 1, {half}), slice({x}, {half} + 1, {half}), (p, q) -> p ^ q), {x})"


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = flat(batch.column("text"))
            ids, hubs = batch.column("id").to_pylist(), batch.column("hubs").to_pylist()
            out: list[tuple] = []
            size = 0
            for r, tokens in shingle_sets(data, off, width):
                if int(set_id(tokens).view(np.int64)) == ids[r]:  # rows of one id may differ in text
                    out.append((ids[r], hubs[r], tokens.view(np.int64)))
                    size += len(tokens)
                if out and (size > 1 << 17 or r == batch.num_rows - 1):
                    at = np.concatenate(([0], np.cumsum([len(x[2]) for x in out])))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.list_(pa.int64())),
                         pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.concatenate([x[2] for x in out])))], names=["id", "hubs", "tokens"])
                    out, size = [], 0

    return run


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row of ``docs``.

    Linked are documents with ``den * |intersection| >= num * |union|`` of their distinct ``width``-word shingles; the
    component is the smallest id reachable by links.  Null and wordless texts have an empty set and link with nothing;
    null ids never become a component's id unless it has no other; repeated rows give a row each.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    folds = [f"s{k}" for k in range(FOLD)]
    kind = "doc long, n long, id long, keys array<long>, wide array<long>, " + ", ".join(f"{s} long" for s in folds)
    sigs = staged(texts.withColumnRenamed("doc", "id").mapInArrow(_signatures(width, num, den), kind), "sketches")
    full = sigs.where("n > 0")
    # Copies collapse before their keys are counted: one document stands for each set.  Only sets with copies are joined, so that
    # most rows meet a small table.
    pick = full.groupBy(F.col("id").alias("of")).agg(F.min("doc").alias("pick"), F.count("*").alias("c"))
    pick = staged(pick, "picks")
    copied = pick.where("c > 1").drop("c")
    one_each = (full.join(checked_broadcast(copied, copied.count()), F.col("id") == F.col("of"), "left")
                .where(F.col("of").isNull() | F.col("doc").eqNullSafe(F.col("pick"))).drop("of", "pick"))

    def close(pairs: DataFrame) -> DataFrame:
        """Pairs whose long sketches, if they have any, do not rule them out; the longer is folded to the shorter's size."""
        side = lambda at: (one_each.where(F.size("wide") > 0).dropDuplicates(["id"])
                           .select(F.col("id").alias(at), F.struct("n", "wide").alias(f"of_{at}")))
        return (pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
                .withColumns({"x": F.expr(_folded("of_a.wide", "of_b.wide")), "y": F.expr(_folded("of_b.wide", "of_a.wide"))})
                .where(F.expr(f"""x is null or y is null or size(x) <> size(y) or aggregate(zip_with(x, y, (p, q) -> bit_count(p ^ q)), 0,
                    (s, v) -> s + v) * {den + num} <= (of_a.n + of_b.n) * {den - num}""")).select("a", "b"))

    def verify(pairs: DataFrame) -> DataFrame:
        """Exact sets, read from one document each: a hub's set goes once, a member's once per pair."""
        pairs = staged(close(pairs), "close")
        at = pairs.select(F.col("b").alias("of"), F.col("a").alias("hub")).unionByName(pairs.select(F.col("a").alias("of"), F.col("a").alias("hub")))
        need = staged(at.groupBy("of").agg(F.collect_set("hub").alias("hubs"))
                      .join(pick, "of").select(F.col("of").alias("id"), "hubs", "pick"), "need")
        sets = (texts.join(checked_broadcast(need, need.count()), F.col("doc").eqNullSafe(F.col("pick"))).select("id", "hubs", "text")
                .mapInArrow(_sets(width), "id long, hubs array<long>, tokens array<long>"))
        # Staged once a document; the copies for its hubs are made after the scan.
        sets = staged(sets, "sets").select("id", F.explode("hubs").alias("hub"), "tokens")
        one = sets.where("id = hub").select("hub", F.col("tokens").alias("x"))
        two = sets.where("id <> hub").select("hub", F.col("id").alias("b"), F.col("tokens").alias("y"))
        both = two.join(one, "hub").withColumn("common", F.size(F.array_intersect("x", "y")))
        return (both.where(den * F.col("common") >= num * (F.size("x") + F.size("y") - F.col("common")))
                .select(F.col("hub").alias("a"), "b").distinct())

    def near(l, r):
        flips = sum((F.bit_count(l(s).bitwiseXOR(r(s))) for s in folds), F.lit(0))
        return flips * (den + num) <= (l("n") + r("n")) * (den - num)

    label = link_buckets(one_each.select("id", "keys", "n", *folds), ["n", *folds], near, verify, sparse=True)
    named = (full.select("doc", "n", "id").join(label.withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left")
             .select("doc", "n", F.coalesce("comp", "id").alias("comp")))
    low = named.groupBy(F.col("comp").alias("c")).agg(F.min("doc").alias("low"))
    return (named.join(low, F.col("comp") == F.col("c")).select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("low").alias("component_id"))
            .unionByName(sigs.where("n = 0").select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("doc").alias("component_id"))))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
