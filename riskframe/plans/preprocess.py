"""Preprocessing plan (section 3.1): raw table -> model table -> split -> fitted statistics -> vectors.

Lazy DataFrame steps throughout; the only eager work is the parse-rate job of the role resolution,
the small bucket-count jobs of the exact split and the statistics job on the train rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.features import add_amount_features, add_time_features, sanitize_target, target_drop_count
from riskframe.operators.roles import (
    TARGET, Roles, amount_balance_columns, date_like_columns, feature_column_kinds,
    identity_columns, resolve_event_time,
)


@dataclass
class ModelTable:
    df: DataFrame  # row_id, feature columns..., label
    roles: Roles
    numeric: list[str]
    categorical: list[str]


def with_row_id(raw: DataFrame, row_key: str | None) -> DataFrame:
    """A stable ``row_id``: the given key column, else a 64-bit hash of the whole row.

    Identical rows get identical ids; they are interchangeable, so every split stays exact.
    """
    rid = F.col(row_key).cast("bigint") if row_key else F.xxhash64(*[F.col(c) for c in raw.columns])
    return raw.withColumn("row_id", rid)


def build_model_table(raw: DataFrame, target: str = TARGET, row_key: str | None = None,
                      match: str = "substring") -> ModelTable:
    """P6 -> P4 -> P3 -> P5 -> P7 -> P8 -> P9 as one lazy projection over the scan."""
    original = list(raw.columns)
    df = sanitize_target(with_row_id(raw, row_key), target)
    ts, rule = resolve_event_time(df.drop("row_id"), match)
    amount, balance = amount_balance_columns(raw.schema, match)
    date_like = date_like_columns(original, match)
    dropped = identity_columns(original, target, [amount, balance] + date_like, match)
    df = df.drop(*dropped)
    df = add_amount_features(df, amount, balance)
    df = add_time_features(df, ts)
    raw_dates = date_like_columns([c for c in df.columns if c != "row_id"], match)
    x_cols = [c for c in df.columns if c not in {target, "row_id", *raw_dates}]
    model = df.select("row_id", *x_cols, F.col(target).alias("label"))
    numeric, categorical = feature_column_kinds(model.schema, exclude=["row_id", "label"])
    roles = Roles(target=target, amount=amount, balance=balance, event_time=rule,
                  date_like=date_like, dropped=dropped)
    return ModelTable(model, roles, numeric, categorical)


@dataclass
class Prepared:
    model: ModelTable
    split: DataFrame      # row_id, features..., label, split (checkpointed)
    prep: object          # FittedPrep
    vectors: DataFrame    # row_id, split, label, features
    dropped_rows: int     # rows without a 0/1 label (P6)


def run_preprocess(raw: DataFrame, out_dir: str | None = None, target: str = TARGET, row_key: str | None = None,
                   match: str = "substring", seed: int = 42) -> Prepared:
    """Section 3.1 end to end: model table -> exact stratified split -> train-only fit -> vectors, and
    (with ``out_dir``) the sinks S2-S6: features, dense features, fitted statistics, manifest, ratios."""
    from riskframe.operators.metrics import class_ratio
    from riskframe.operators.prep import fit_prep
    from riskframe.operators.split import stratified_split
    from riskframe.session import materialize
    from riskframe.sources import sinks

    mt = build_model_table(raw, target, row_key, match)
    split = stratified_split(mt.df, seed=seed)  # stores its rows
    dropped = target_drop_count(raw, split)
    prep = fit_prep(split.where(F.col("split") == "train"), mt.numeric, mt.categorical)
    vectors = materialize(prep.transform(split).select("row_id", "split", "label", "features"))
    if out_dir:
        out = out_dir.rstrip("/")
        sinks.write_features(vectors, f"{out}/processed/features")
        sinks.write_dense(vectors, f"{out}/processed/dense")
        sinks.write_prep(prep, raw.sparkSession, f"{out}/processed/preprocessor")
        sinks.write_version(split, prep, f"{out}/processed/versions")
        sinks.write_json(sinks.manifest(split, prep, mt.roles, target), f"{out}/processed/manifest")
        sinks.write_json(sinks.manifest_rows(split, prep, mt.roles, target, dropped), f"{out}/processed/manifest_rows")
        sinks.write_csv(class_ratio(split, ["split"]), f"{out}/metrics/split_fraud_ratio")
    return Prepared(mt, split, prep, vectors, dropped)
