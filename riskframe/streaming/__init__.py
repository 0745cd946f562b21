"""Scoring new transactions as they arrive.

The reference has no streaming operators (no windows, watermarks or state).  Its derived features, the
fitted preprocessing and the fitted models are all stateless row expressions, so the same objects apply
unchanged to a Structured Streaming DataFrame; this module only wires them together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators.features import add_amount_features, add_time_features
from riskframe.operators.models import positive_scores


def score_transactions(df: DataFrame, roles, event_ts: Column, prep, model, name: str = "model",
                       row_key: str | None = None) -> DataFrame:
    """Raw transactions (batch or stream) -> ``(row_id, model, score)`` with fitted ``prep`` and ``model``.

    ``roles`` and ``event_ts`` come from the training run's role resolution (no parse-rate job is run on a
    stream); the label is not needed.
    """
    rid = F.col(row_key).cast("bigint") if row_key else F.xxhash64(*[F.col(c) for c in df.columns])
    d = df.withColumn("row_id", rid)
    d = add_time_features(add_amount_features(d, roles.amount, roles.balance), event_ts)
    v = prep.transform(d).withColumn("label", F.lit(None).cast("int"))
    return positive_scores(model, v, name).drop("label")
