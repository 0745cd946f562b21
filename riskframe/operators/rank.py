"""Exact rank cuts without a global sort.

Splits, client partitions and subsamples all ask one question: *which rank interval of a seeded random
order does each row fall in?*  ``row_number() OVER (PARTITION BY label ORDER BY h)`` answers it, but
puts a whole stratum (up to all rows) in one task.  Here the rows are stored once, with a unique row number, and only
the row *at* each interval's lower end is looked for, digit by digit:

1. the first pass counts rows per (stratum, lead keys, top 8 bits of the 32-bit order hash): each map task emits at most
   256 partial counts per stratum whatever the data size; a window over that small table finds the bucket of each cut;
2. later passes count only the rows of those buckets (one per cut) by the next digit: three more of the hash, then the tiebreak
   column, then four of a hash of the row number, so equal ids are told apart too;
3. once the buckets hold few rows (``window_rows``), a ``row_number`` inside them gives the cut rows' keys.

Then one map-side pass tags every row with the interval of the last cut at or before its own key.  The result is
that of the plain window (ties on the hash broken by the tiebreak column, further ties by row number).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.session import materialize

LEVEL_BITS = (8, 8, 8, 8)
# Rows of the cuts' buckets left for the final exact window.
WINDOW_ROWS = 1 << 22
# Upper bound (rows) for a bucket table we broadcast; above it the joins fall back to shuffles.
BROADCAST_ROWS = 2_000_000

SegmentFn = Callable[[DataFrame], DataFrame]


def join_groups(left: DataFrame, small: DataFrame, by: Sequence[str], *, few: bool, how: str = "inner") -> DataFrame:
    """Join on group columns in which NULL is a group like any other; ``small`` is broadcast only where it is ``few``."""
    names = {c: f"_of_{c}" for c in by}
    right = small.withColumnsRenamed(names)
    cond = F.lit(True)
    for c, of in names.items():
        cond = cond & F.col(c).eqNullSafe(F.col(of))
    return left.join(F.broadcast(right) if few else right, cond, how).drop(*names.values())


def _maybe_broadcast(df: DataFrame, n_rows: int) -> DataFrame:
    return F.broadcast(df) if n_rows <= BROADCAST_ROWS else df


def assign_by_rank(
    df: DataFrame,
    *,
    hash_col: str,
    tiebreak: str,
    segments: SegmentFn,
    strata: Sequence[str] = (),
    lead: Sequence[str] = (),
    level_bits: Sequence[int] = LEVEL_BITS,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Attach the payload of the rank interval each row falls in.

    Rows are ranked 1..n within ``strata`` by ``(lead..., hash_col, tiebreak)``, equal ones by a row number.  ``segments``
    receives a DataFrame ``(strata..., n)`` of stratum sizes and returns ``(strata..., _lo, _hi, payload...)``:
    inclusive, disjoint rank intervals covering ``1..n``.  Every input row comes out exactly once with
    the payload columns added.  ``strata`` and ``lead`` must be low-cardinality columns (the driver handles one row per
    cut) and ``sum(level_bits) <= 32``.  ``df`` is read once: it is stored in the checkpoint folder.
    """
    lead = list(lead)
    groups = list(strata) or ["_all"]
    d = df if strata else df.withColumn("_all", F.lit(0))
    d = materialize(d.withColumn("_u", F.monotonically_increasing_id()))
    spark = d.sparkSession
    spread = F.xxhash64("_u")
    digits = {f"_p{i}": F.shiftright(F.col(hash_col), 32 - used) for i, used in enumerate(_cumulative(level_bits))}
    if sum(level_bits) == 32:  # the whole hash: equal ones may be told apart further
        digits["_t"] = F.col(tiebreak)
        digits |= {f"_v{i}": F.shiftright(spread, 64 - 8 * (i + 1)) for i in range(4)}
    slim = d.select(*dict.fromkeys([*groups, *lead, hash_col, tiebreak, "_u"]))
    full = [*lead, hash_col, tiebreak, "_v", "_u"]
    key = F.struct(*[F.col(c) if c != "_v" else spread.alias("_v") for c in full])

    segs = None
    held = None  # one row per cut: group, digits so far, rows before and in its bucket, rank of the cut
    keys = [*groups, *lead]
    for name, digit in digits.items():
        found = [*keys, name]
        if held is None:
            src = slim.withColumn(name, digit)
        else:
            buckets = held.select(*keys, F.col("_start").alias("_before")).distinct()
            src = join_groups(slim.withColumns({k: digits[k] for k in (*(x for x in keys if x in digits), name)}), buckets, keys, few=True)
        counts = src.groupBy(*found, *([] if held is None else ["_before"])).agg(F.count(F.lit(1)).alias("_cnt"))
        upto = (Window.partitionBy(*groups).orderBy(*lead, name) if held is None else Window.partitionBy(*keys).orderBy(name))
        start = F.coalesce(F.sum("_cnt").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        counts = counts.withColumn("_start", (start + (F.lit(0) if held is None else F.col("_before"))).cast("bigint"))
        if segs is None:
            counts = counts.persist()
            totals = counts.groupBy(*groups).agg(F.sum("_cnt").cast("bigint").alias("n"))
            got = segments(totals if strata else totals.drop("_all"))
            got = got if strata else got.withColumn("_all", F.lit(0))
            segs = spark.createDataFrame(got.collect(), got.schema)
            cuts = segs.where("_lo > 1").select(*groups, F.col("_lo").alias("_rank"))
        else:
            cuts = held.select(*keys, "_rank")
        on = groups if held is None else keys
        chosen = join_groups(counts, cuts, on, few=True).where("_start < _rank and _rank <= _start + _cnt").select(*found, "_start", "_cnt", "_rank")
        rows = chosen.collect()  # one row per cut
        if held is None:
            counts.unpersist()
        held, keys = spark.createDataFrame(rows, chosen.schema), found
        if sum({tuple(r[c] for c in found): r["_cnt"] for r in rows}.values()) <= window_rows:
            break

    buckets = held.select(*keys, "_start").distinct()
    near = join_groups(slim.withColumns({k: digits[k] for k in keys if k in digits}), buckets, keys, few=True)
    order = [*lead, hash_col, tiebreak, spread, "_u"]
    ranked = near.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) + F.col("_start"))
    at = join_groups(ranked, held.select(*groups, "_rank").distinct(), [*groups, "_rank"], few=True).select(*groups, "_rank", key.alias("_key"))
    payload = [c for c in segs.columns if c not in {*groups, "_lo", "_hi"}]
    table = join_groups(segs.withColumn("_rank", F.col("_lo").cast("bigint")), at, [*groups, "_rank"], few=True, how="left")
    table = table.groupBy(*groups).agg(F.sort_array(F.collect_list(F.struct("_lo", "_key", *payload))).alias("_cuts"))
    table = spark.createDataFrame(table.collect(), table.schema)  # one row per stratum
    tagged = join_groups(d, table, groups, few=True)
    mine = F.element_at(F.filter("_cuts", lambda c: (c["_lo"] == 1) | (c["_key"] <= key)), -1)
    return tagged.withColumn("_mine", mine).select(*df.columns, *[F.col(f"_mine.{c}").alias(c) for c in payload])


def _cumulative(bits: Sequence[int]) -> list[int]:
    out, total = [], 0
    for b in bits:
        total += b
        out.append(total)
    if total > 32:
        raise ValueError("level bits must add up to at most 32")
    return out


# ---------------------------------------------------------------------------------------------
# Interval builders: each maps stratum sizes ``n`` to rank intervals, with Spark expressions only.


def intervals_from_sizes(totals: DataFrame, keys: Sequence[str], sizes: Column, names: Column,
                         name_col: str | None = None) -> DataFrame:
    """Turn an array of part sizes (same order as ``names``) into consecutive rank intervals.

    ``names`` holds one payload value per part; struct payloads are expanded to their fields
    (then ``name_col`` is ignored).
    """
    parts = F.arrays_zip(names.alias("name"), sizes.alias("size"))
    exploded = totals.select(*keys, F.posexplode(parts).alias("_pos", "_part"))
    w = Window.partitionBy(*keys).orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    out = (
        exploded.withColumn("_size", F.col("_part.size").cast("bigint"))
        .withColumn("_lo", F.coalesce(F.sum("_size").over(w), F.lit(0)) + 1)
        .withColumn("_hi", F.col("_lo") + F.col("_size") - 1)
        .where(F.col("_size") > 0)
    )
    if isinstance(out.schema["_part"].dataType["name"].dataType, T.StructType):
        return out.select(*keys, "_lo", "_hi", "_part.name.*")
    return out.select(*keys, "_lo", "_hi", F.col("_part.name").alias(name_col))


def ntile_sizes(n: Column, k: int) -> Column:
    """Sizes of ``k`` near-equal parts of ``n`` rows, the first ``n mod k`` one larger (``ntile``)."""
    q = F.floor(n / k)
    r = n - q * k
    return F.transform(F.sequence(F.lit(1), F.lit(k)), lambda i: F.when(i <= r, q + 1).otherwise(q))


# ---------------------------------------------------------------------------------------------
# Exact row numbers in a value order (not a hash order), for ordered numbering inside large groups.


def count_below(sorted_cuts: Column, x: Column, steps: int) -> Column:
    """Number of elements of an ascending array below ``x``, by a fixed-step binary search."""

    def step(acc, _):
        lo, hi = acc["lo"], acc["hi"]
        mid = ((lo + hi) / 2).cast("int")
        active = lo < hi
        less = F.coalesce(F.try_element_at(sorted_cuts, mid + 1) < x, F.lit(False))
        return F.struct(F.when(active & less, mid + 1).otherwise(lo).alias("lo"),
                        F.when(active & ~less, mid).otherwise(hi).alias("hi"))

    init = F.struct(F.lit(0).alias("lo"), F.size(sorted_cuts).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step, lambda acc: acc["lo"])


def ordered_row_number(df: DataFrame, by: Sequence[str], order: str, out: str = "rn",
                       buckets: int = 1024, accuracy: int = 20_000) -> DataFrame:
    """``row_number() OVER (PARTITION BY by ORDER BY order)`` for a column of distinct values per group,
    without one task per group: values are cut into order-preserving buckets at approximate quantiles
    (per group), bucket counts are cumulated over a small table, and the exact number comes from a window
    inside each (group, bucket)."""
    by = list(by)
    probs = [i / buckets for i in range(1, buckets)]
    cuts = df.groupBy(*by).agg(F.percentile_approx(F.col(order).cast("double"), probs, accuracy).alias("_cuts")).persist()
    n_groups = cuts.count()
    steps = max(1, (buckets - 1).bit_length()) + 1
    d = df.join(_maybe_broadcast(cuts, n_groups * buckets), by) \
        .withColumn("_b", count_below(F.col("_cuts"), F.col(order).cast("double"), steps)).drop("_cuts")
    counts = d.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_b", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off")).persist()
    n_off = offsets.count()
    within = Window.partitionBy(*by, "_b").orderBy(order)
    return (d.join(_maybe_broadcast(offsets, n_off), [*by, "_b"])
            .withColumn(out, (F.row_number().over(within) + F.col("_off")).cast("int"))
            .drop("_b", "_off"))
