"""Whitening of vectors: covariances by polarisation, exact in integers, and an eigendecomposition of the d x d matrix.

Each entry c becomes x = floor(1024 c) + 100000.  The variance of the sum of two dimensions, less those of both, is twice their
covariance, so only squares are summed: one exact sum of squared centred values per dimension and per sum of two.  Values are centred
at the whole number below the mean before they are squared; the rest of the mean is taken off exactly afterwards.
Sums per task are whole numbers, put together as decimals; only d (d + 1) / 2 of them ever reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import staged, table
from riskframe.session import ship_package

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
# Eigenvalues below this share of the largest are those of directions without spread.
FLAT = 1e-12
# Rows of vectors that one step squares at a time.
STEP = 4096


def fit_list(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, x array<long>)`` of the rows whose vector is not null and holds no null or non-finite entry.

    Vectors without entries go too; where lengths differ, those of the commonest length stay (the shorter on ties).
    """
    v = F.col(vec_col)
    whole = F.size(v) > 0
    finite = ~F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    good = rows.where(v.isNotNull() & whole & F.coalesce(finite, F.lit(False))).select(
        F.col(id_col).alias("vec_id"), F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT).alias("x"))
    sizes = good.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").limit(2).collect()
    return good.where(F.size("x") == sizes[0]["d"]) if len(sizes) > 1 else good


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Record batches with their vectors as a matrix of whole numbers."""
    for b in batches:
        if b.num_rows:
            col = b.column("x")
            yield b, col.flatten().to_numpy().reshape(b.num_rows, -1)


def _sums(x: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the sum of each dimension, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for _, m in _blocks(batches):
            high, low = (m >> 20).sum(axis=0), (m & ((1 << 20) - 1)).sum(axis=0)
            got = [(int(h) << 20) + int(w) for h, w in zip(high, low)]
            n, total = n + len(m), got if total is None else [a + b for a, b in zip(total, got)]
        if n:
            d = len(total)
            yield pa.RecordBatch.from_arrays([pa.array([n] * d, pa.int64()), pa.array(range(d), pa.int32()),
                                              pa.array([str(t) for t in total])], names=["n", "i", "s"])

    got = (x.select("x").mapInArrow(run, "n long, i int, s string").groupBy("i")
           .agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect())
    return (got[0]["n"] if got else 0), [int(r["s"]) for r in got]


def _square_sums(x: DataFrame, centre: list[int]) -> dict[tuple[int, int], int]:
    """Exact sums of squares of (x_i - c_i) for i = j and of (x_i - c_i) + (x_j - c_j) for i < j."""
    d = len(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, c = np.zeros((d, d), object), np.array(centre, np.int64)
        for _, m in _blocks(batches):
            m = m - c
            most = 2 * int(np.abs(m).max()) or 1
            # As many rows at once as cannot overflow 63 bits; entries beyond 2^30 are squared as Python numbers.
            take = min(STEP, (1 << 62) // (most * most))
            if take == 0:
                m, take = m.astype(object), STEP
            for k in range(0, len(m), take):
                part = np.ascontiguousarray(m[k : k + take].T)
                for i in range(d):
                    s = part[i:] + part[i]
                    s[0] = part[i]
                    total[i, i:] += np.einsum("ij,ij->i", s, s).astype(object) if s.dtype != object else (s * s).sum(axis=1)
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(t) for t in total[i, j]])],
                                         names=["i", "j", "q"])

    got = (x.select("x").mapInArrow(run, "i int, j int, q string").groupBy("i", "j")
           .agg(F.sum(F.col("q").cast("decimal(38,0)")).alias("q")).collect())
    return {(r["i"], r["j"]): int(r["q"]) for r in got}


def covariance(x: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """n, the sums S of the dimensions, and the covariance matrix (divisor n), each entry exact up to its rounding."""
    n, sums = _sums(x)
    d = len(sums)
    if n == 0:
        return 0, [], np.zeros((0, 0))
    centre = [s // n for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre)]  # sum of centred values
    q = _square_sums(x, centre)
    # n^2 times the variance of a dimension, and of the sum of two.
    own = [n * q[i, i] - rest[i] ** 2 for i in range(d)]
    v = np.empty((d, d))
    for i in range(d):
        v[i, i] = float(Fraction(own[i], n * n))
        for j in range(i + 1, d):
            both = n * q[i, j] - (rest[i] + rest[j]) ** 2
            v[i, j] = v[j, i] = float(Fraction(both - own[i] - own[j], 2 * n * n))
    return n, sums, v


def whiten(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` per vector of the fit list and component.

    Vectors are as ``fit_list`` leaves them, each row by itself whatever its id; other columns are ignored; an empty fit list
    gives an empty table.  Directions without spread (equal vectors, fewer vectors than dimensions) have ``whitened`` null and do not
    count in ``identity_error``; without any spread ``explained`` is null too.  A ``deviation`` beyond a long is null.
    """
    spark = rows.sparkSession
    ship_package(spark)
    x = staged(fit_list(rows, id_col, vec_col), "whiten-fit")
    n, sums, v = covariance(x)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if n == 0:
        return spark.createDataFrame([], schema)
    value, vector = np.linalg.eigh(v)
    order = np.argsort(-value, kind="stable")[:components]
    value, vector, trace = value[order], vector[:, order], float(np.trace(v))
    alive = value > FLAT * max(float(value[0]), 0.0)
    scaled = vector / np.sqrt(np.where(alive, value, 1.0))
    k = len(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.array(sums, object)
        for b, m in _blocks(batches):
            most = max(abs(int(m.max())), abs(int(m.min())), max(map(abs, sums)) // n + 1)
            if 2 * n * most < 1 << 62:
                dev = n * m - np.array(sums, np.int64)
                top = int(np.abs(dev).max())
                square = (dev * dev).sum(axis=1).tolist() if top * top * m.shape[1] < 1 << 62 else (dev.astype(object) ** 2).sum(axis=1)
            else:
                dev = n * m.astype(object) - total
                square = (dev * dev).sum(axis=1)
            w = (dev.astype(float) / n) @ scaled
            w = pa.array(w.ravel(), mask=np.tile(~alive, len(m)))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array([int(s) if s < 1 << 63 else None for s in square], pa.int64()),
                                              pa.ListArray.from_arrays(np.arange(0, k * len(m) + 1, k, dtype=np.int32), w)], names=["vec_id", "deviation", "w"])

    id_type = x.schema["vec_id"].dataType.simpleString()
    white = staged(x.mapInArrow(run, f"vec_id {id_type}, deviation long, w array<double>"), "whitened")
    live = np.flatnonzero(alive).tolist()
    pairs = [(a, b) for a in live for b in live if a <= b]
    error = 0.0
    if pairs:
        got = white.agg(*[F.covar_pop(F.get("w", F.lit(a)), F.get("w", F.lit(b))).alias(f"c{a}_{b}") for a, b in pairs]).first()
        error = max(abs(got[f"c{a}_{b}"] - (a == b)) for a, b in pairs)
    share = F.array(*[F.lit(float(e / trace) if trace > 0 else None).cast("double") for e in value])
    return (white.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                    F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
