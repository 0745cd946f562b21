"""Small helpers shared by the operators: staged tables, checked broadcasts, flat views of Arrow text."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import ensure_checkpoint_dir

# Rows of a small table that may be broadcast; beyond it the same join shuffles.
BROADCAST_ROWS = 200_000
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Bytes of text that one vectorised step handles at a time (a longer text is a step of its own).
STEP_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, what: str) -> str:
    """A fresh path below the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{what}-{uuid.uuid4().hex}"


def write_stage(df: DataFrame, path: str, options: dict[str, str] | None = None) -> None:
    """Write ``df`` as Parquet; the shuffle files of this one write go when it ends, since later passes read the table."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").options(**(options or {})).parquet(path)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)


def staged(df: DataFrame, what: str = "stage", options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again: later passes neither recompute it
    nor depend on an executor that may be lost."""
    spark = df.sparkSession
    path = shared_path(spark, what)
    write_stage(df, path, options)
    back = spark.read.schema(df.schema).parquet(path)
    back.staged_path = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete the folders of ``staged`` tables that nothing reads any more."""
    for df in tables:
        remove(df.sparkSession, df.staged_path)


def row_key(*cols: str) -> Column:
    """Hash of a row's own values, null being a value: a key where ids are null or repeat."""
    return F.xxhash64(*cols, *[F.col(c).isNull() for c in cols])


def checked_broadcast(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only for a table whose counted ``rows`` stay below ``limit``; else a plain shuffle join."""
    return F.broadcast(df) if rows <= limit else df


def remove(spark: SparkSession, path: str) -> None:
    """Delete one staged folder of our own through the Hadoop FileSystem."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def flat(col) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column end to end, and the n+1 offsets of its rows (null reads as empty)."""
    a = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if a.null_count:
        a = a.fill_null("")
    a = a.cast(pa.large_binary())
    n = len(a)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + n + 1]
    data = a.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def steps(off: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of at most ``limit`` bytes each (at least one row)."""
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RollingHash:
    """64-bit polynomial hashes of any byte ranges of a buffer from one cumulative sum.

    Each byte value maps to a random odd 64-bit number; ``at(i, j)`` hashes bytes i..j-1.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(2**62, 2**63, dtype=np.uint64)) * 2 + 5 & (2**64 - 1) | 1
        self.inverse = pow(self.base, -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, STEP_BYTES + 1)
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.r_[np.uint64(1), np.full(n, self.base, np.uint64)])
                self.down = np.cumprod(np.r_[np.uint64(1), np.full(n, self.inverse, np.uint64)])

    def load(self, data: np.ndarray, lut: np.ndarray | None = None) -> None:
        self._powers(len(data) + 1)
        values = self.values if lut is None else self.values[lut]
        with np.errstate(over="ignore"):
            self.sums = np.empty(len(data) + 1, np.uint64)
            self.sums[0] = 0
            np.cumsum(values[data] * self.up[: len(data)], out=self.sums[1:])

    def at(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# White space of the word rule [^\x20\x09-\x0D]+ .
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words(data: np.ndarray, off: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of every word of the rows, and the n+1 word offsets of the rows.

    A word is a longest run of bytes outside ``breaks``; words never cross rows.
    """
    inside = ~breaks[data]
    prev = np.empty_like(inside)
    prev[:1] = False
    prev[1:] = inside[:-1]
    edge = off[:-1][off[:-1] < len(data)]
    prev[edge] = False
    start = np.flatnonzero(inside & ~prev)
    nxt = np.empty_like(inside)
    nxt[-1:] = False
    nxt[:-1] = inside[1:]
    nxt[edge[edge > 0] - 1] = False
    end = np.flatnonzero(inside & ~nxt) + 1
    return start, end, np.searchsorted(start, off)
