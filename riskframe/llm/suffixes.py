"""Removal of repeated byte strings by suffix arrays, sorted in two stages.

A string of ``LENGTH`` bytes that starts at two places must be found although no task sees all text.  Anchors bring equal
strings together: the ``GRAM``-byte gram of smallest hash in each window of ``LENGTH`` bytes depends on the window's content only, so equal strings
share an anchor at the same offset.  Anchors that occur once are dropped by a count; around the others the text that
windows with that anchor can cover (a chunk) goes to the task of its anchor.  Equal chunks collapse before that:
a chunk that occurs twice is repeated as a whole.

A task concatenates its different chunks and builds their suffix array in two stages: only suffixes smaller than their successor are
sorted directly; the others are induced by scanning the buckets of the first byte in order.  Common prefixes of neighbours
then give the strings that start at two places.  An anchor with more than ``HOT`` different chunks (the edge of a passage that very many
documents share) is parted before that, see ``part_hot``; no task gets more than ``HOT`` chunks of one group.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.common import RollingHash, checked_broadcast, discard, flat, mix, staged, steps, table
from riskframe.session import ship_package

LENGTH, GRAM = 200, 88
REACH = LENGTH - GRAM  # a window starts at most so far before its anchor
HOT = 5000
BATCH_BYTES = 1 << 17
_HASH = RollingHash(97)


def _slide(x: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``size`` neighbours, by doubling."""
    span = 1
    while 2 * span <= size:
        x = pick(x[: len(x) - span], x[span:])
        span *= 2
    return pick(x[: len(x) - (size - span)], x[size - span :]) if size > span else x


def anchors(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, gram hash, chunk hash) of the anchors of texts lying end to end."""
    n, w = len(data), REACH + 1
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    _HASH.load(data)
    pos = np.arange(n - GRAM + 1)
    h = _HASH.at(pos, pos + GRAM) | np.uint64(1)
    low = _slide(h, w, np.minimum)  # of the window that starts here
    inside = np.zeros(n + 1, np.int8)
    begin, end = off[:-1], off[1:] - LENGTH + 1
    ok = end > begin
    np.add.at(inside, begin[ok], 1)
    np.add.at(inside, end[ok], -1)
    low[np.cumsum(inside[: len(low)]) == 0] = 0  # windows never cross texts
    pad = np.zeros(w - 1, np.uint64)
    at = np.flatnonzero(_slide(np.concatenate([pad, low, pad]), w, np.maximum) == h)
    text = np.searchsorted(off, at, side="right") - 1
    lo, hi = np.maximum(off[text], at - REACH), np.minimum(off[text + 1], at + LENGTH)
    with np.errstate(over="ignore"):
        chunk = mix(_HASH.at(lo, hi) + (at - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return at, h[at], chunk


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = flat(batch.column("text"))
        keys = batch.column("t").to_numpy()
        for i, j in steps(off):
            cut = off[i : j + 1] - off[i]
            at, h, chunk = anchors(data[off[i] : off[j]], cut)
            text = np.searchsorted(cut, at, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), pa.array(chunk.view(np.int64)), pa.array(keys[i + text]), pa.array((at - cut[text]).astype(np.int64)),
                 pa.array((cut[text + 1] - cut[text]).astype(np.int64))], names=["h", "c", "t", "pos", "n"])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the chunks wanted from each text."""
    for batch in batches:
        for text, wanted in zip(batch.column("text"), batch.column("want")):
            raw, rows = (text.as_py() or "").encode(), wanted.as_py()
            for i in range(0, len(rows), 2000):
                part = rows[i : i + 2000]
                lo = [max(0, x["pos"] - REACH) for x in part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x["h"] for x in part], pa.int64()), pa.array([x["t"] for x in part], pa.int64()), pa.array([x["many"] for x in part], pa.bool_()),
                     pa.array(lo, pa.int64()), pa.array([raw[a : x["pos"] + LENGTH] for a, x in zip(lo, part)], pa.binary()),
                     pa.array([x["pos"] - a for a, x in zip(lo, part)], pa.int32())], names=["h", "t", "many", "lo", "chunk", "x"])


def suffix_order(text: np.ndarray, need: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes of ``text`` in order of their first ``depth`` values, in two stages.

    ``text`` holds positive values, a 0 after each chunk and one more 0 at the end.  ``need`` marks a set of starts that with a suffix larger than
    its successor holds the successor too.  Suffixes smaller than their successor are sorted directly; then each bucket of a first
    value, lowest first, is scanned: a suffix in it induces the one that starts a place earlier, if that is larger.
    """
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int16)))  # -1: falls after here
    last = np.where(step != 0, np.arange(n - 1), n)
    nxt = np.minimum.accumulate(last[::-1])[::-1]  # next place where the value changes
    small = np.ones(n, bool)
    small[:-1] = np.where(nxt < n - 1, step[np.minimum(nxt, n - 2)] > 0, False)
    small[text == 0] = True
    raw = text.tobytes()
    direct = np.flatnonzero(small & need)
    width = text.itemsize * depth
    size = text.itemsize
    keys = [raw[j * size : j * size + width] for j in direct.tolist()]
    direct = direct[np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)] if len(keys) else direct
    first = text[direct]
    by_value = {int(v): direct[first == v] for v in np.unique(first)}
    induced: dict[int, list[np.ndarray]] = {}
    out = []
    for v in range(int(text.max()) + 1):
        pieces = induced.pop(v, [])
        mine = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)
        done = [mine]
        while len(mine):  # runs of one value: the bucket induces its own next members
            before = mine[mine > 0] - 1
            mine = before[(text[before] == v) & ~small[before] & need[before]]
            done.append(mine)
        bucket = np.concatenate([*done, by_value.get(v, np.zeros(0, np.int64))])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[~small[before] & need[before] & (text[before] > v)]
        for x in np.unique(text[before]):
            induced.setdefault(int(x), []).append(before[text[before] == x])
    return np.concatenate(out)


def repeated_starts(chunks: list[bytes], place: np.ndarray, many: np.ndarray) -> list[np.ndarray]:
    """For each chunk the starts of its strings of ``LENGTH`` bytes that also start elsewhere.

    ``place`` is each chunk's (text, first byte) as one number per byte place, so that one place seen through two chunks counts
    once; ``many`` marks chunks that occur more than once themselves.
    """
    size = np.array([len(c) for c in chunks])
    text = np.frombuffer(b"\0".join(chunks) + b"\0", np.uint8).astype(np.uint8)
    begin = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    owner = np.repeat(np.arange(len(chunks)), size + 1)
    # One byte a place where the text has no zero byte, else two; the separator is below all.
    zeros = (text == 0).sum() > len(chunks)
    wide = np.zeros(len(text) + 1, ">u2" if zeros else np.uint8)
    wide[:-1] = text.astype(np.uint16) + 1 if zeros else text
    wide[(begin + size)] = 0
    n = len(wide)
    # Starts whose string lies in its chunk, and what induces them: up to the next suffix smaller than its successor.
    step = np.sign(np.diff(wide.astype(np.int32)))
    stop = np.zeros(n, bool)
    stop[1:-1] = (step[1:] > 0)
    stop[wide == 0] = True
    upto = np.minimum.accumulate(np.where(stop, np.arange(n), n - 1)[::-1])[::-1][begin + size - LENGTH]
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, begin, 1)
    np.add.at(edge, upto + 1, -1)
    need = np.cumsum(edge[:-1]) > 0
    order = suffix_order(wide, need, LENGTH + 8)
    order = order[order < n - 1]
    order = order[(begin + size)[owner[order]] - order >= LENGTH]
    # Common prefixes of neighbours, eight bytes at a time.
    padded = np.concatenate([text, np.zeros(LENGTH + 16, np.uint8)])
    eight = np.empty((len(padded) - 8) // 8 * 8, np.uint64)  # the eight bytes from every place as one number
    for r in range(8):
        eight[r::8] = padded[r : r + len(eight)].view(np.uint64)
    a, b = order[:-1], order[1:]
    for k in range(0, LENGTH, 8):
        alike = eight[a + k] == eight[b + k]
        if not alike.all():
            a, b = a[alike], b[alike]
    same = np.flatnonzero(np.isin(order[:-1], a, kind="table")) if len(a) else np.zeros(0, np.int64)
    joined = np.zeros(len(order) + 1, bool)
    joined[same + 1] = True
    run = np.cumsum(~joined[:-1]) - 1 if len(order) else np.zeros(0, np.int64)
    spot = place[owner[order]] + (order - begin[owner[order]])
    runs = int(run[-1]) + 1 if len(run) else 0
    lo, hi = np.full(runs, np.iinfo(np.int64).max), np.full(runs, np.iinfo(np.int64).min)
    np.minimum.at(lo, run, spot)
    np.maximum.at(hi, run, spot)
    twice = np.bincount(run, minlength=runs) > 1
    often = np.zeros(runs, bool)
    np.logical_or.at(often, run, many[owner[order]])
    hit = order[(twice & ((lo != hi) | often))[run]] if runs else order
    hit = np.sort(hit)
    cut = np.searchsorted(hit, np.append(begin, n))
    return [hit[cut[i] : cut[i + 1]] - begin[i] for i in range(len(chunks))]


def _spans(starts: np.ndarray, lo: int) -> list[dict]:
    gap = np.flatnonzero(np.diff(starts) > LENGTH)
    first = starts[np.concatenate(([0], gap + 1))]
    last = starts[np.concatenate((gap, [len(starts) - 1]))]
    return [{"lo": lo + int(a), "hi": lo + int(b) + LENGTH} for a, b in zip(first, last)]


def _sort_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor -> spans (t, lo, hi) of repeated strings, a suffix array per batch of whole anchors."""

    def give(rows: list[tuple]) -> pa.RecordBatch:
        _, t, many, lo, chunks = zip(*rows)
        _, number = np.unique(np.array(t), return_inverse=True)
        found = repeated_starts(list(chunks), (number.astype(np.int64) << 40) + np.array(lo), np.array(many))
        out = [(t[i], s["lo"], s["hi"]) for i, starts in enumerate(found) if len(starts) and not many[i] for s in _spans(starts, lo[i])]
        cols = list(zip(*out)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["t", "lo", "hi"])

    rows: list[tuple] = []
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("h", "t", "many", "lo", "chunk"))):
            if size >= BATCH_BYTES and row[0] != rows[-1][0]:
                yield give(rows)
                rows, size = [], 0
            rows.append(row)
            size += len(row[4])
    if rows:
        yield give(rows)


def _alike(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        k = (lo + hi + 1) // 2
        lo, hi = (k, hi) if a[lo:k] == b[lo:k] else (lo, k - 1)
    return lo


def _against_hub(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks beside the hub of their group -> spans ``(t, lo, hi)`` of the strings shared with it (``chunk`` null) and what is left of each chunk, see ``part_hot``."""
    for batch in batches:
        out, spans = [], set()
        for h, t, many, lo, chunk, x, least, most, hub in zip(*(batch.column(c).to_pylist() for c in ("h", "t", "many", "lo", "chunk", "x", "least", "most", "hub"))):
            if (t, lo, x) == (hub["t"], hub["lo"], hub["x"]):
                continue
            at, end = hub["x"], x + GRAM
            left = _alike(chunk[:x][::-1], hub["chunk"][:at][::-1])
            right = _alike(chunk[end:], hub["chunk"][at + GRAM :])
            a, b = max(least, REACH - right), min(left, most)
            if a <= b:
                spans |= {(u, p - b, p - a + LENGTH) for u, p, whole in ((t, lo + x, many), (hub["t"], hub["lo"] + at, hub["many"])) if not whole}
            for a, b, key in ((max(least, left + 1), most, b"l" + chunk[max(0, x - left - 1) : x]), (least, min(left, REACH - right - 1, most), b"r" + chunk[end : end + right + 1])):
                if a <= b:
                    group = int.from_bytes(blake2b(key, digest_size=8, key=h.to_bytes(8, "big", signed=True)).digest(), "big", signed=True)
                    out.append((group, t, many, lo, None, chunk, x, a, b))
        out += [(None, t, None, lo, hi, None, None, None, None) for t, lo, hi in spans]
        cols = list(zip(*out)) or [()] * 9
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(cols, kinds)], names=["h", "t", "many", "lo", "hi", "chunk", "x", "least", "most"])


def part_hot(cut: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Chunks in groups of at most ``HOT``, and spans ``(t, lo, hi)`` of the strings that members of larger groups share with the hubs of these.

    A string to judge is known by how many bytes s it reaches to the left of the anchor; [``least``, ``most``] are those still to judge of a chunk.  One
    chunk of a hot group, its hub, is compared with all others: one that agrees with it in ``left`` bytes before the anchor and ``right`` bytes behind it shares the
    strings from REACH - right to left.  Those of larger s it can share only with chunks of the same first left + 1 bytes, the others with chunks
    of the same right + 1 bytes behind: the groups of the next round.  The ranges never overlap, so a passage that all members have is settled at
    once however long it is, and a chunk's rows do not double with each round.  A chunk alone in its group repeats nothing.
    """
    groups = (cut.withColumn("least", F.greatest(F.lit(0), LENGTH - (F.octet_length("chunk") - F.col("x"))).cast("int"))
              .withColumn("most", F.least(F.lit(REACH), "x").cast("int")).where("least <= most"))
    done, spans = [], []
    columns = ["h", "t", "many", "lo", "chunk", "x", "least", "most"]
    while True:
        sizes = staged(groups.groupBy(F.col("h").alias("g")).agg(F.count("*").alias("kinds"), F.min_by(F.struct("t", "lo", "x"), F.xxhash64("t", "lo", "h")).alias("hub"))
                       .where(F.col("kinds") > HOT).select("g", "hub"), "hot")
        n_hot = sizes.count()
        if not n_hot:
            done.append(groups)
            break
        done.append(groups.join(checked_broadcast(sizes.select("g"), n_hot), F.col("h") == F.col("g"), "left_anti"))
        hubs = staged(groups.join(checked_broadcast(sizes, n_hot), (F.col("h") == F.col("g")) & (F.struct("t", "lo", "x") == F.col("hub")))
                      .select("g", F.struct("t", "many", "lo", "chunk", "x").alias("hub")).dropDuplicates(["g"]), "hubs")
        parts = staged(groups.join(checked_broadcast(hubs, n_hot), F.col("h") == F.col("g")).select(*columns, "hub")
                       .mapInArrow(_against_hub, "h long, t long, many boolean, lo long, hi long, chunk binary, x int, least int, most int"), "parts")
        spans.append(parts.where("chunk is null").select("t", "lo", "hi"))
        alone = parts.where("chunk is not null").groupBy(F.col("h").alias("g")).agg(F.count("*").alias("kinds")).where("kinds > 1").select("g")
        groups = staged(parts.where("chunk is not null").join(alone, F.col("h") == F.col("g"), "left_semi").select(*columns), "groups")
    few = done[0]
    for more in done[1:]:
        few = few.unionByName(more)
    common = None
    for more in spans:
        common = more if common is None else common.unionByName(more)
    return few, common


def repeated_spans(texts: DataFrame) -> DataFrame:
    """``(t, spans array<struct<lo, hi>>)`` of ``texts(t, text)``: byte ranges (overlapping, unsorted) covered by repeated strings."""
    found = staged(texts.mapInArrow(_anchors, "h long, c long, t long, pos long, n long"), "anchors")
    shared = (found.groupBy(F.col("h").alias("g")).agg(F.count("*").alias("k"), F.min("c").alias("c0"), F.max("c").alias("c1"))
              .where("k > 1").select("g", (F.col("c0") != F.col("c1")).alias("varied")))
    dup = staged(found.join(shared, F.col("h") == F.col("g")).select("h", "c", "t", "pos", "n", "varied"), "shared")
    discard(found)
    whole = lambda df: df.select("t", F.greatest(F.col("pos") - REACH, F.lit(0)).alias("lo"), F.least(F.col("pos") + LENGTH, "n").alias("hi"))
    variants = staged(dup.where("varied").groupBy("h", "c").agg(F.count("*").alias("k"), F.min("t").alias("t")), "variants")
    again = variants.where("k > 1").select(F.col("h").alias("h2"), F.col("c").alias("c2"))
    spans = whole(dup.where("not varied")).unionByName(
        whole(dup.where("varied").join(again, (F.col("h") == F.col("h2")) & (F.col("c") == F.col("c2")))))
    # One place of each variant; its chunk is cut from that text.
    at = (dup.where("varied").join(variants.select(F.col("h").alias("h2"), F.col("c").alias("c2"), F.col("t").alias("t2"), F.col("k")),
                                   (F.col("h") == F.col("h2")) & (F.col("c") == F.col("c2")) & (F.col("t") == F.col("t2")))
          .groupBy("h", "c", "t").agg(F.min("pos").alias("pos"), (F.max("k") > 1).alias("many")))
    want = at.groupBy("t").agg(F.collect_list(F.struct("h", "t", "pos", "many")).alias("want")).withColumnRenamed("t", "of")
    cut = staged(texts.dropDuplicates(["t"]).join(want, F.col("t") == F.col("of")).select("text", "want")
                 .mapInArrow(_chunks, "h long, t long, many boolean, lo long, chunk binary, x int"), "chunks")
    few, common = part_hot(cut)
    few = few.select("h", "t", "many", "lo", "chunk")
    spans = spans.unionByName(few.repartition("h").sortWithinPartitions("h", "t", "lo").mapInArrow(_sort_chunks, "t long, lo long, hi long"))
    if common is not None:
        spans = spans.unionByName(common)
    return spans.groupBy("t").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc, text, spans in zip(*(batch.column(c) for c in ("doc", "text", "spans"))):
            raw = (text.as_py() or "").encode()
            kept, done, removed, runs = [], 0, 0, 0
            reach = -1
            for lo, hi in sorted((s["lo"], s["hi"]) for s in spans.as_py() or ()):
                if lo > reach:  # a new maximal run; touching spans are one
                    runs += 1
                if lo > done:
                    kept.append(raw[done:lo])
                if hi > done:
                    removed += hi - max(lo, done)
                    done = hi
                reach = max(reach, hi)
            kept.append(raw[done:])
            rest = b"".join(kept)
            out.append((len(raw), removed, runs, sha256(rest).hexdigest(), rest))
        cols = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays([batch.column("doc"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.binary())],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept binary)`` per row of ``docs``.

    Every byte covered by a string of 200 bytes that also starts anywhere else goes; strings never cross rows and are judged on the
    input.  Null texts are empty; texts below 200 bytes keep all; repeated rows repeat each other and go whole.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("t", F.xxhash64("doc", "text"))
    spans = repeated_spans(rows.select("t", "text")).withColumnRenamed("t", "of")
    return (rows.join(spans, F.col("t") == F.col("of"), "left").select("doc", "text", "spans")
            .mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
