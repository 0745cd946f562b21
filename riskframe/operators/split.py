"""Row splits and client partitions (D1-D5) and the training-row cap.

Every split is an exact rank cut over a seeded hash order (see :mod:`riskframe.operators.rank`):
exact per-class counts, deterministic, disjoint, covering - and no single-task window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.hashing import order_hash
from riskframe.session import materialize
from riskframe.operators.rank import assign_by_rank, intervals_from_sizes, ntile_sizes

SEED = 42
MIX_SEED_SALT = "mix"
# Rows per partition of a capped training table: four partitions of 60,000 rows, which Spark ML sums up in one step (eight take two).
TRAIN_PART_ROWS = 16_384

# Fixed values of the reference's skewed three-client mix (positive and negative shares per client).
BANK_POSITIVE_SHARES = (0.15, 0.30, 0.55)
BANK_NEGATIVE_SHARES = (0.45, 0.35, 0.20)


def split_sizes(n, train_pct: int = 70, val_pct_of_rest: int = 50):
    """(train, val, test) row counts of one class: floor(70% n), then floor(50%) of the rest to val."""
    t = F.floor(n * train_pct / 100).cast("bigint")
    v = F.floor((n - t) * val_pct_of_rest / 100).cast("bigint")
    return t, v, n - t - v


def stratified_split(
    df: DataFrame,
    label: str = "label",
    row_id: str = "row_id",
    seed: int = SEED,
    train_pct: int = 70,
    val_pct_of_rest: int = 50,
    out_col: str = "split",
) -> DataFrame:
    """Stratified train / val / test split with exact per-class counts."""
    d = df.withColumn("_h", order_hash(row_id, seed))

    def segments(totals: DataFrame) -> DataFrame:
        t, v, r = split_sizes(F.col("n"), train_pct, val_pct_of_rest)
        names = F.array(F.lit("train"), F.lit("val"), F.lit("test"))
        return intervals_from_sizes(totals, [label], F.array(t, v, r), names, out_col)

    return assign_by_rank(d, hash_col="_h", tiebreak=row_id, segments=segments, strata=[label]).drop("_h")


def subsample(df: DataFrame, n_max: int, row_id: str = "row_id", seed: int = SEED) -> DataFrame:
    """Keep ``n_max`` rows chosen without replacement by seeded order; ``n_max <= 0`` keeps all."""
    if n_max <= 0:
        return df
    d = df.withColumn("_h", order_hash(row_id, seed, "subsample"))

    def segments(totals: DataFrame) -> DataFrame:
        keep = F.least(F.col("n"), F.lit(n_max))
        sizes = F.array(keep, F.col("n") - keep)
        return intervals_from_sizes(totals, [], sizes, F.array(F.lit(True), F.lit(False)), "_keep")

    out = assign_by_rank(d, hash_col="_h", tiebreak=row_id, segments=segments)
    return out.where("_keep").drop("_keep", "_h")


def training_sample(df: DataFrame, n_max: int, row_id: str = "row_id", seed: int = SEED, part_rows: int = TRAIN_PART_ROWS) -> DataFrame:
    """P11, stored for estimators that make many short passes: the capped rows lie in as many partitions as they fill, whatever
    number ``df`` came in, so that a pass costs the same for every size of ``df``.  Uncapped rows stay as they are."""
    kept = materialize(subsample(df, n_max, row_id, seed))
    if n_max <= 0:
        return kept
    parts = -(-kept.count() // part_rows)
    if parts <= 1:
        return kept.coalesce(1)
    return materialize(kept.repartition(parts, row_id).sortWithinPartitions(row_id))


def client_names(k: int):
    return F.array(*[F.lit(f"w{i + 1}") for i in range(k)])


def _local_split(df: DataFrame, order_hash_col: str, row_id: str, lead: Sequence[str], local_train_frac: float) -> DataFrame:
    """Local train/validation by position inside each client: the first floor(0.85 n) rows train."""

    def segments(totals: DataFrame) -> DataFrame:
        t = F.floor(F.col("n") * F.lit(float(local_train_frac))).cast("bigint")
        sizes = F.array(t, F.col("n") - t)
        return intervals_from_sizes(totals, ["client_id"], sizes, F.array(F.lit("train"), F.lit("val")), "local_split")

    return assign_by_rank(df, hash_col=order_hash_col, tiebreak=row_id, segments=segments,
                          strata=["client_id"], lead=lead)


def partition_clients(
    df: DataFrame,
    mode: str = "iid",
    n_clients: int = 3,
    label: str = "label",
    row_id: str = "row_id",
    seed: int = SEED,
    local_train_frac: float = 0.85,
    shares: dict | None = None,
) -> DataFrame:
    """Name clients ``w1..wk`` and mark each row's ``local_split`` (train / val).

    * ``iid``: seeded order, ``k`` near-equal parts (first ``n mod k`` parts one larger).
    * ``noniid``: order by label then seed, ``k`` contiguous parts (label skew).
    * ``bank_noniid``: per-label shares per client; defaults to the fixed three-client mix,
      ``shares={'pos': [...], 'neg': [...]}`` generalises it to any number of clients.
    """
    d = df.withColumn("_h", order_hash(row_id, seed))
    if mode in ("iid", "noniid"):
        # Clients are contiguous ranges of one order and the local split is a cut inside each range,
        # so one rank pass assigns both.
        lead = [] if mode == "iid" else [label]
        frac = F.lit(float(local_train_frac))

        def segments(totals: DataFrame) -> DataFrame:
            sizes = F.flatten(F.transform(
                ntile_sizes(F.col("n"), n_clients),
                lambda s: F.array(F.floor(s * frac).cast("bigint"), s - F.floor(s * frac).cast("bigint"))))
            names = F.array(*[F.struct(F.lit(f"w{i + 1}").alias("client_id"), F.lit(part).alias("local_split"))
                              for i in range(n_clients) for part in ("train", "val")])
            return intervals_from_sizes(totals, [], sizes, names)

        out = assign_by_rank(d, hash_col="_h", tiebreak=row_id, segments=segments, lead=lead)
    elif mode == "bank_noniid":
        pos = list((shares or {}).get("pos", BANK_POSITIVE_SHARES))
        neg = list((shares or {}).get("neg", BANK_NEGATIVE_SHARES))
        if shares is None and n_clients != 3:
            raise ValueError("the default label mix is given for three clients; pass pos and neg shares for others")
        if len(pos) != len(neg):
            raise ValueError("pos and neg shares need one entry per client")
        k = len(pos)

        def segments(totals: DataFrame) -> DataFrame:
            def sizes(sh):
                first = [F.floor(F.col("n") * F.lit(float(s))).cast("bigint") for s in sh[:-1]]
                rest = F.col("n") - sum(first[1:], first[0]) if first else F.col("n")
                return F.array(*first, rest)

            sz = F.when(F.col(label) == 1, sizes(pos)).otherwise(sizes(neg))
            return intervals_from_sizes(totals, [label], sz, client_names(k), "client_id")

        parts = assign_by_rank(d, hash_col="_h", tiebreak=row_id, segments=segments, strata=[label])
        # The local order is a second, independent shuffle: cut the lineage before ranking again.
        parts = materialize(parts.withColumn("_h2", order_hash(row_id, seed, MIX_SEED_SALT)))
        out = _local_split(parts, "_h2", row_id, [], local_train_frac).drop("_h2")
    else:
        raise ValueError("unknown client mode: use iid, noniid or bank_noniid")
    return out.drop("_h")
