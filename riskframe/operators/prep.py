"""Fitted transformers (T1-T6) and the feature-vector output.

Statistics are fitted on the train rows only and kept as small tables; applying them is a projection
(imputation, scaling) plus one join per categorical column with the category dictionary.

* T1 exact median by radix selection: values are counted by sign and binary exponent, then by ever finer equal
  slices of the one slice that holds the middle rank.  All columns share each pass; a pass emits at most ``SLICES``
  counts per column and task, and no pass sorts or ranks values.
* T2 mean and population standard deviation of the *imputed* values (zero deviation -> scale 1), one wide aggregate.
* T3 most frequent value, smallest on ties, from a distributed value count.
* T4/T6 one-hot positions from a dictionary table: the distinct values of all categorical columns, range-partitioned in
  order; a value's number is its place in its partition plus the rows of the partitions before.  An unseen value has no position.
* T5 rows as (position, value) entries or as sparse index and value arrays, never as a dense array.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.session import materialize

# Equal slices that a pass of the median cuts a range into.
SLICES = 4096
# Beyond every binary exponent of a double, so that exponents plus this number are positive.
EXPONENT_SHIFT = 1100
NUM_PREFIX, CAT_PREFIX = "num__", "cat__"
# Bytes of category text (with 32 a row) up to which a dictionary is broadcast; beyond, its join shuffles.
DICTIONARY_BYTES = 64 << 20


def _long(df: DataFrame, cols: Sequence[str], cast: str | None = None) -> DataFrame:
    """(col_name, x) pairs of the non-null values of ``cols`` (one projection, no shuffle)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("col_name"),
                               (F.col(c).cast(cast) if cast else F.col(c)).alias("x")) for c in cols])
    return df.select(F.inline(pairs)).where(F.col("x").isNotNull())


def _slice_of(x: Column, lo: float | None, hi: float | None) -> Column:
    """Number of the slice a value lies in: by sign and exponent without a range, else one of ``SLICES`` equal ones.

    Never falls as x grows: logarithm, difference and quotient of doubles are monotone.
    """
    if lo is None or hi is None:
        size = F.when(F.abs(x) == float("inf"), F.lit(2000)).otherwise(F.floor(F.log2(F.abs(x))).cast("int"))
        return F.when(x == 0, F.lit(0)).otherwise(F.signum(x).cast("int") * (size + EXPONENT_SHIFT))
    return F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * SLICES).cast("int"), F.lit(SLICES - 1))


def exact_medians(df: DataFrame, cols: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """Exact (interpolating) median of each column, NULL and NaN ignored: ``(col_name, median)``; a column without values has no row.

    Radix selection: one pass per digit counts, for all columns at once, the values per slice with the smallest and largest
    of each.  If the two middle ranks fall into different slices, or into one of a single value, the column is
    done; else the next pass looks only at that slice.  Seven passes at most (one of exponents, ``SLICES`` a pass after that).  ``accuracy``
    is accepted for older callers; the result is exact without it.
    """
    spark = df.sparkSession
    todo: dict[str, tuple] = {c: (None, None, 0, None) for c in cols}  # column -> (lo, hi, rows before, rows in all)
    done: dict[str, float] = {}
    while todo:
        entries = []
        for c, (lo, hi, _, _) in todo.items():
            x = F.col(c).cast("double")
            inside = ~F.isnan(x) if lo is None else x.between(lo, hi)
            entries.append(F.struct(F.lit(c).alias("col_name"), F.when(inside, x).alias("x"), F.when(inside, _slice_of(x, lo, hi)).alias("slice")))
        counts = (df.select(F.inline(F.array(*entries))).where("x is not null")
                  .groupBy("col_name", "slice").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")))
        # At most SLICES rows (2 x 2,100 exponents at first) per column are cumulated here.
        known = spark.createDataFrame([(c, s[2], s[3]) for c, s in todo.items()], "col_name string, before long, total long")
        upto = Window.partitionBy("col_name").orderBy("slice")
        counts = (counts.join(F.broadcast(known), "col_name")
                  .withColumn("total", F.coalesce("total", F.sum("n").over(Window.partitionBy("col_name"))))
                  .withColumn("last", F.sum("n").over(upto) + F.col("before")).withColumn("first", F.col("last") - F.col("n") + 1)
                  .withColumn("k1", F.floor((F.col("total") + 1) / 2)).withColumn("k2", F.floor(F.col("total") / 2) + 1)
                  .where("first <= k2 and last >= k1"))
        found: dict[str, list] = {}
        for r in counts.orderBy("col_name", "slice").collect():  # one or two rows per column
            found.setdefault(r["col_name"], []).append(r)
        after = {}
        for c, rows in found.items():
            if len(rows) == 2:
                done[c] = (rows[0]["hi"] + rows[1]["lo"]) / 2.0
            elif rows[0]["lo"] == rows[0]["hi"]:
                done[c] = rows[0]["lo"]
            elif rows[0]["n"] == 2:
                done[c] = (rows[0]["lo"] + rows[0]["hi"]) / 2.0 if rows[0]["k1"] != rows[0]["k2"] else rows[0]["lo" if rows[0]["k1"] == rows[0]["first"] else "hi"]
            else:
                after[c] = (rows[0]["lo"], rows[0]["hi"], rows[0]["first"] - 1, rows[0]["total"])
        todo = after
    return spark.createDataFrame([(c, float(done[c])) for c in cols if c in done], "col_name string, median double")


def column_means_scales(df: DataFrame, cols: Sequence[str], fill: dict[str, float]) -> DataFrame:
    """Mean and population deviation of the imputed columns: ``(col_name, mean, scale)``, one wide aggregate."""
    cols = list(cols)
    if not cols:
        return df.sparkSession.createDataFrame([], "col_name string, mean double, scale double")
    x = [F.coalesce(F.col(c).cast("double"), F.lit(fill.get(c, 0.0))) for c in cols]
    wide = df.agg(*[F.avg(v).alias(f"m{i}") for i, v in enumerate(x)], *[F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(x)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("col_name"), F.col(f"m{i}").alias("mean"), F.when(F.col(f"s{i}") == 0, F.lit(1.0)).otherwise(F.col(f"s{i}")).alias("scale"))
        for i, c in enumerate(cols)]))).where("mean is not null")


def column_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Most frequent non-null value per column, the smallest on ties: ``(col_name, mode)``."""
    counts = _long(df, cols, "string").groupBy("col_name", "x").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.groupBy("col_name").agg(F.min_by("x", F.struct(-F.col("cnt"), F.col("x"))).alias("mode"))


def category_dictionary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(cpos, category, idx)``, every distinct non-null value of ``cols`` numbered from 0 by (column, value).

    ``cpos`` is the column's place in ``cols``; values compare by their UTF-8 bytes.  Values are range-partitioned and
    sorted inside their partitions; only the partitions' row counts (one row each) are cumulated by a window.
    """
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "cpos int, category string, idx long")
    values = F.array(*[F.struct(F.lit(i).alias("cpos"), F.col(c).cast("string").alias("category")) for i, c in enumerate(cols)])
    distinct = df.select(F.inline(values)).where("category is not null").distinct()
    at = F.monotonically_increasing_id()
    placed = materialize(distinct.repartitionByRange("cpos", "category").sortWithinPartitions("cpos", "category")
                         .select("cpos", "category", F.shiftright(at, 33).alias("part"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("place")))
    rows = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.select(F.col("part").alias("of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return placed.join(offsets, F.col("part") == F.col("of")).select("cpos", "category", (F.col("place") + F.col("offset")).cast("long").alias("idx"))


@dataclass
class FittedPrep:
    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float]
    means: dict[str, float]
    scales: dict[str, float]
    modes: dict[str, str]
    dictionary: DataFrame            # cpos, category, idx
    starts: dict[str, int]           # first idx of each categorical column
    sizes: dict[str, int]            # categories of each categorical column
    dictionary_bytes: int = 0

    def names(self) -> DataFrame:
        """``(pos, feature)``: ``num__<col>``, then ``cat__<col>_<category>`` in sorted category order."""
        spark = self.dictionary.sparkSession
        numeric = spark.createDataFrame([(i, NUM_PREFIX + c) for i, c in enumerate(self.numeric)], "pos int, feature string")
        if not self.categorical:
            return numeric
        col = F.element_at(F.array(*[F.lit(c) for c in self.categorical]), F.col("cpos") + 1)
        return numeric.unionByName(self.dictionary.select(
            (F.col("idx") + len(self.numeric)).cast("int").alias("pos"), F.concat(F.lit(CAT_PREFIX), col, F.lit("_"), F.col("category")).alias("feature")))

    @property
    def n_features(self) -> int:
        return len(self.numeric) + sum(self.sizes.values())

    @property
    def feature_names(self) -> list[str]:
        """T6 as a list, for few categories; ``names`` is the table."""
        return [r["feature"] for r in self.names().orderBy("pos").collect()]

    def statistics(self, spark: SparkSession) -> DataFrame:
        """The fitted statistics as a table ``(col_name, stat, value, text)``."""
        rows = []
        for c in self.numeric:
            rows += [(c, "median", self.medians.get(c), None), (c, "mean", self.means.get(c), None),
                     (c, "scale", self.scales.get(c), None)]
        for c in self.categorical:
            rows.append((c, "mode", None, self.modes.get(c)))
        return spark.createDataFrame(rows, "col_name string, stat string, value double, text string")

    def impute_scale(self, df: DataFrame) -> DataFrame:
        """T1 + T2 + T3 as one projection (broadcast-free: statistics are literals)."""
        cols = {}
        for c in self.numeric:
            x = F.coalesce(F.col(c).cast("double"), F.lit(self.medians.get(c, 0.0)))
            cols[f"_n_{c}"] = (x - F.lit(self.means[c])) / F.lit(self.scales[c])
        for c in self.categorical:
            cols[f"_c_{c}"] = F.coalesce(F.col(c).cast("string"), F.lit(self.modes.get(c)))
        return df.withColumns(cols)

    def with_dictionary(self, df: DataFrame, values: DataFrame | None = None, prefix: str = "_i_") -> DataFrame:
        """T4: imputed rows with, per categorical column c, ``<prefix>c``: what ``values(cpos, category, v)`` holds for the row's
        category (its ``idx`` unless given), NULL for an unseen one.  A dictionary of few bytes is broadcast, so rows stay where they are."""
        values = values if values is not None else self.dictionary.withColumnRenamed("idx", "v")
        small = self.dictionary_bytes <= DICTIONARY_BYTES
        for i, c in enumerate(self.categorical):
            side = values.where(F.col("cpos") == i).select(F.col("category").alias(f"_k_{c}"), F.col("v").alias(f"{prefix}{c}"))
            df = df.join(F.broadcast(side) if small else side, F.col(f"_c_{c}") == F.col(f"_k_{c}"), "left").drop(f"_k_{c}")
        return df

    def _entries(self) -> Column:
        """Array of (pos, value) of a row of ``with_dictionary``, positions rising, zeros and unseen categories left out."""
        entry = lambda pos, value: F.struct(pos.cast("int").alias("pos"), value.alias("value"))
        cells = [entry(F.lit(i), F.col(f"_n_{c}")) for i, c in enumerate(self.numeric)]
        cells += [entry(F.col(f"_i_{c}") + len(self.numeric), F.lit(1.0)) for c in self.categorical]
        return F.filter(F.array(*cells), lambda e: e["pos"].isNotNull() & (e["value"] != 0))

    def entries(self, df: DataFrame, keys: Sequence[str] = ("row_id",)) -> DataFrame:
        """T5: ``(keys..., pos, value)``, one row per non-zero feature of each row."""
        return self.with_dictionary(self.impute_scale(df)).select(*keys, F.inline(self._entries()))

    def sparse_rows(self, df: DataFrame, keys: Sequence[str] = ("row_id",)) -> DataFrame:
        """T5: ``(keys..., size, indices, values)``, the sparse layout of each row's features."""
        rows = self.with_dictionary(self.impute_scale(df)).select(*keys, self._entries().alias("_e"))
        return rows.select(*keys, F.lit(self.n_features).alias("size"), F.col("_e.pos").alias("indices"), F.col("_e.value").alias("values"))

    def transform(self, df: DataFrame, out: str = "features") -> DataFrame:
        """T5 for estimators: the same features as one Spark ML vector (sparse where that is shorter)."""
        d = self.with_dictionary(self.impute_scale(df))
        parts = [f"_n_{c}" for c in self.numeric]
        used = [c for c in self.categorical if self.sizes[c]]
        if used:
            # An unseen category is number ``size``, the one that the encoder leaves out.
            d = d.withColumns({f"_x_{c}": F.coalesce(F.col(f"_i_{c}") - self.starts[c], F.lit(self.sizes[c])).cast("double") for c in used})
            d = self._encoder(used, d.sparkSession).transform(d)
            parts += [f"_o_{c}" for c in used]
        d = VectorAssembler(inputCols=parts, outputCol=out, handleInvalid="keep").transform(d)
        drop = [f"_n_{c}" for c in self.numeric] + [f"{p}{c}" for c in self.categorical for p in ("_c_", "_i_", "_x_", "_o_")]
        return d.drop(*[c for c in drop if c in d.columns])

    def _encoder(self, used: list[str], spark: SparkSession) -> OneHotEncoderModel:
        """One-hot encoder that knows only how many categories a column has."""
        largest = spark.createDataFrame([tuple(float(self.sizes[c]) for c in used)], ", ".join(f"`_x_{c}` double" for c in used))
        return OneHotEncoder(inputCols=[f"_x_{c}" for c in used], outputCols=[f"_o_{c}" for c in used], dropLast=True).fit(largest)


def fit_prep(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> FittedPrep:
    """Fit T1-T4 on the train rows only (a handful of jobs, each over all columns at once).

    Per numeric column three numbers and per categorical column its mode and size come to the driver; categories stay in a table.
    """
    numeric, categorical = list(numeric), list(categorical)
    medians = {r["col_name"]: r["median"] for r in exact_medians(train, numeric).collect()}
    ms = {r["col_name"]: (r["mean"], r["scale"]) for r in column_means_scales(train, numeric, medians).collect()}
    modes = {r["col_name"]: r["mode"] for r in column_modes(train, categorical).collect()} if categorical else {}
    return with_sizes(numeric, categorical, medians, {c: ms.get(c, (0.0, 1.0))[0] for c in numeric}, {c: ms.get(c, (0.0, 1.0))[1] for c in numeric},
                      modes, materialize(category_dictionary(train, categorical)))


def with_sizes(numeric: list[str], categorical: list[str], medians: dict, means: dict, scales: dict, modes: dict, dictionary: DataFrame) -> FittedPrep:
    """Fitted statistics with the number of categories, first index and bytes of each column, counted from a stored dictionary."""
    stats = {r["cpos"]: r for r in dictionary.groupBy("cpos").agg(
        F.min("idx").alias("start"), F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("category") + 32).alias("bytes")).collect()}
    start, n = {}, 0
    for i, c in enumerate(categorical):
        start[c] = stats[i]["start"] if i in stats else n
        n = start[c] + (stats[i]["n"] if i in stats else 0)
    return FittedPrep(numeric, categorical, medians, means, scales, modes, dictionary, start,
                      {c: stats[i]["n"] if i in stats else 0 for i, c in enumerate(categorical)}, sum(r["bytes"] for r in stats.values()))


def dense_features(df: DataFrame, col: str = "features", out: str = "x") -> DataFrame:
    """S3: the feature vector as ``array<float>`` (the dense float32 layout)."""
    return df.withColumn(out, vector_to_array(F.col(col), "float32"))


def nonzero_long(df: DataFrame, col: str = "features", keys: Sequence[str] = ("row_id",)) -> DataFrame:
    """Feature vectors as long ``(keys..., pos, value)`` rows of their non-zero entries."""
    return (df.select(*keys, F.posexplode(vector_to_array(F.col(col), "float64")).alias("pos", "value"))
            .where(F.col("value") != 0))
