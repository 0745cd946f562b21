"""Catalog: fitted transformers on the train split (build-plan step 4)."""

from __future__ import annotations


from pyspark.sql import functions as F

from riskframe.catalog.prep import txn_model, txn_split
from riskframe.catalog.sqlparts import R6, SPLIT_CTE, TXN_MODEL_CTE, with_ctes
from riskframe.operators.roles import feature_column_kinds
from riskframe.operators.prep import column_means_scales, column_modes, exact_medians, fit_prep

# The txn model table's column kinds (P10 resolves them from the schema; the oracle
# SQL needs them spelled out).
TXN_NUMERIC = ("Transaction_Amount", "Account_Balance", "amount_to_balance_ratio", "amount_minus_balance",
               "is_over_balance", "log_amount", "tx_hour", "tx_day_of_week", "is_weekend", "is_night")
TXN_CATEGORICAL = ("Transaction_Type", "Segment", "Nation")


def _kinds(spark, sf_dir):
    mt = txn_model(spark, sf_dir)
    return mt.numeric, mt.categorical


def _train(spark, sf_dir):
    return txn_split(spark, sf_dir).where(F.col("split") == "train")


def fitted(spark, sf_dir):
    split = txn_split(spark, sf_dir)
    numeric, categorical = feature_column_kinds(split.schema, exclude=["row_id", "label", "split"])  # P10
    return split, fit_prep(split.where(F.col("split") == "train"), numeric, categorical)


def q_impute_median(spark, sf_dir):
    numeric, _ = _kinds(spark, sf_dir)
    return exact_medians(_train(spark, sf_dir), numeric).select("col_name", F.round("median", R6).alias("median"))


def q_standardize(spark, sf_dir):
    numeric, _ = _kinds(spark, sf_dir)
    train = _train(spark, sf_dir)
    med = {r["col_name"]: r["median"] for r in exact_medians(train, numeric).collect()}
    ms = column_means_scales(train, numeric, med)
    return ms.select("col_name", F.round("mean", R6).alias("mean"), F.round("scale", R6).alias("scale"))


def q_impute_mode(spark, sf_dir):
    _, categorical = _kinds(spark, sf_dir)
    return column_modes(_train(spark, sf_dir), categorical).select("col_name", F.col("mode").alias("mode"))


def q_feature_names(spark, sf_dir):
    """Names by position, from the dictionary table."""
    return fitted(spark, sf_dir)[1].names()


def q_one_hot_long(spark, sf_dir):
    """T4 on every split: one row per (row, categorical column) whose value is a train category."""
    split, prep = fitted(spark, sf_dir)
    d = prep.with_dictionary(prep.impute_scale(split))
    names = F.array(*[F.when(F.col(f"_i_{c}").isNotNull(), F.concat(F.lit(f"cat__{c}_"), F.col(f"_c_{c}"))) for c in prep.categorical])
    return d.select("row_id", F.explode(F.filter(names, lambda x: x.isNotNull())).alias("feature"))


def q_prep_vectors(spark, sf_dir):
    """T1-T5 end to end: non-zero entries of every row's features, train-fitted."""
    split, prep = fitted(spark, sf_dir)
    return prep.entries(split, ["row_id", "split"]).withColumn("value", F.round("value", R6))


QUERIES = {
    "impute_median": q_impute_median,
    "standardize": q_standardize,
    "impute_mode": q_impute_mode,
    "feature_names": q_feature_names,
    "one_hot_long": q_one_hot_long,
    "prep_vectors": q_prep_vectors,
}

# ---------------------------------------------------------------------------------------------
# DuckDB oracle

_R = R6
_BASE = with_ctes(TXN_MODEL_CTE, SPLIT_CTE, "train AS (SELECT * FROM split WHERE split = 'train')")


def _num_long(src: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, {i} AS pos, row_id, CAST({c} AS DOUBLE) AS x FROM {src}" for i, c in enumerate(TXN_NUMERIC))


def _cat_long(src: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS col_name, {i} AS cpos, row_id, CAST({c} AS VARCHAR) AS x FROM {src}" for i, c in enumerate(TXN_CATEGORICAL))


_STATS = f"""
, tn AS ({_num_long('train')}),
med AS (SELECT col_name, median(x) AS median FROM tn GROUP BY col_name),
imp AS (SELECT tn.col_name, coalesce(tn.x, med.median) AS x FROM tn JOIN med USING (col_name)),
ms AS (SELECT col_name, avg(x) AS mean, CASE WHEN stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END AS scale
       FROM imp GROUP BY col_name),
tc AS ({_cat_long('train')}),
cnt AS (SELECT col_name, x, count(*) AS c FROM tc WHERE x IS NOT NULL GROUP BY col_name, x),
modes AS (SELECT col_name, x AS mode FROM (
   SELECT *, row_number() OVER (PARTITION BY col_name ORDER BY c DESC, x) AS rk FROM cnt) WHERE rk = 1),
cats AS (SELECT col_name, x, row_number() OVER (PARTITION BY col_name ORDER BY x) - 1 AS ci,
                count(*) OVER (PARTITION BY col_name) AS ncat FROM cnt),
cpos AS (SELECT DISTINCT cats.col_name, tc.cpos, cats.ncat FROM cats JOIN (SELECT DISTINCT col_name, cpos FROM tc) tc
         USING (col_name)),
offs AS (SELECT col_name, {len(TXN_NUMERIC)} + coalesce(sum(ncat) OVER (ORDER BY cpos ROWS BETWEEN UNBOUNDED PRECEDING
         AND 1 PRECEDING), 0) AS off FROM cpos)
"""

ORACLE = {
    "impute_median": _BASE + _STATS + f"SELECT col_name, round(median, {_R}) AS median FROM med",
    "standardize": _BASE + _STATS + f"SELECT col_name, round(mean, {_R}) AS mean, round(scale, {_R}) AS scale FROM ms",
    "impute_mode": _BASE + _STATS + "SELECT col_name, mode FROM modes",
    "feature_names": _BASE + _STATS + """
SELECT CAST(pos AS INTEGER) AS pos, feature FROM (
  SELECT pos, 'num__' || col_name AS feature FROM (SELECT DISTINCT col_name, pos FROM tn)
  UNION ALL
  SELECT off + ci AS pos, 'cat__' || col_name || '_' || x AS feature FROM cats JOIN offs USING (col_name))""",
    "one_hot_long": _BASE + _STATS + f"""
, al AS ({_cat_long('split')})
SELECT al.row_id, 'cat__' || al.col_name || '_' || coalesce(al.x, modes.mode) AS feature
FROM al JOIN modes USING (col_name) JOIN cats ON cats.col_name = al.col_name AND cats.x = coalesce(al.x, modes.mode)""",
    "prep_vectors": _BASE + _STATS + f"""
, an AS ({_num_long('split')}),
al AS ({_cat_long('split')}),
sp AS (SELECT row_id, split FROM split),
v AS (
  SELECT an.row_id, CAST(an.pos AS INTEGER) AS pos, (coalesce(an.x, med.median) - ms.mean) / ms.scale AS value
  FROM an JOIN med USING (col_name) JOIN ms USING (col_name)
  UNION ALL
  SELECT al.row_id, CAST(offs.off + cats.ci AS INTEGER) AS pos, 1.0::DOUBLE AS value
  FROM al JOIN modes USING (col_name) JOIN cats ON cats.col_name = al.col_name AND cats.x = coalesce(al.x, modes.mode)
  JOIN offs ON offs.col_name = al.col_name)
SELECT v.row_id, sp.split, v.pos, round(v.value, {_R}) AS value FROM v JOIN sp USING (row_id) WHERE v.value <> 0""",
}

# SQL up to the table v(row_id, pos, value) of non-zero features, and the names (pos, feature).
VECTORS = ORACLE["prep_vectors"].rsplit("SELECT v.row_id", 1)[0]
NAMES = ORACLE["feature_names"][len(_BASE + _STATS):]
