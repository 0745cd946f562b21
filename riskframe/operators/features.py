"""Label filter and derived features.

All columns are built with JVM expressions in one projection (one whole-stage-codegen span).
Missing values are NULL: pandas' NaN is never produced, so every indicator has an explicit ``otherwise``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names of the derived columns.
AMOUNT_FEATURES = ("amount_to_balance_ratio", "amount_minus_balance", "is_over_balance", "log_amount")
TIME_FEATURES = ("tx_hour", "tx_day_of_week", "is_weekend", "is_night")
NIGHT_HOURS = (0, 1, 2, 3, 4, 5)


def to_number(df: DataFrame, col: str) -> Column:
    """Coerce to double; text that does not parse and NaN both become NULL (missing)."""
    dt = df.schema[col].dataType
    c = F.col(col)
    x = c.cast("double") if isinstance(dt, (T.NumericType, T.BooleanType)) else c.cast("string").try_cast("double")
    return F.nanvl(x, F.lit(None).cast("double"))


def label_value(df: DataFrame, target: str) -> Column:
    """The target coerced to a number (NULL when it does not parse)."""
    return to_number(df, target)


def sanitize_target(df: DataFrame, target: str) -> DataFrame:
    """Keep rows whose target reads as 0 or 1 and store it as int; error when the target is absent."""
    if target not in df.columns:
        raise ValueError(f"the table has no label column {target!r}, only {df.columns}")
    y = label_value(df, target)
    return df.where(y.isin(0.0, 1.0)).withColumn(target, y.cast("int"))


def target_drop_count(df: DataFrame, kept: DataFrame) -> int:
    """Rows of ``df`` that P6 left out of ``kept``, a stored table: one count each, without columns.

    An ``Observation`` would save the count of ``df``, but in a session that has used one, Spark ML models that hold a
    training summary can no longer transform (the summary's session is then not serialisable).
    """
    return df.count() - kept.count()


def amount_feature_columns(amount: Column, balance: Column) -> dict[str, Column]:
    """P7 as expressions over numeric amount and balance columns."""
    return {
        "amount_to_balance_ratio": F.try_divide(amount, balance + F.lit(1.0)),
        "amount_minus_balance": amount - balance,
        "is_over_balance": F.when(amount > balance, F.lit(1)).otherwise(F.lit(0)),
        "log_amount": F.when(amount.isNotNull(), F.log1p(F.greatest(amount, F.lit(0.0)))),
    }


def add_amount_features(df: DataFrame, amount_col: str, balance_col: str) -> DataFrame:
    """Coerce amount and balance to numbers in place and add the four amount features."""
    df = df.withColumns({amount_col: to_number(df, amount_col), balance_col: to_number(df, balance_col)})
    return df.withColumns(amount_feature_columns(F.col(amount_col), F.col(balance_col)))


def time_feature_columns(ts: Column) -> dict[str, Column]:
    """Hour, day of week (Monday = 0), weekend and night flags as doubles."""
    hour = F.hour(ts)
    dow = F.weekday(ts)
    return {
        "tx_hour": hour,
        "tx_day_of_week": dow,
        "is_weekend": F.when(dow >= 5, F.lit(1.0)).otherwise(F.lit(0.0)),
        "is_night": F.when(hour.isin(*NIGHT_HOURS), F.lit(1.0)).otherwise(F.lit(0.0)),
    }


def add_time_features(df: DataFrame, ts: Column) -> DataFrame:
    """P8 from an event timestamp expression (see :func:`riskframe.operators.roles.resolve_event_time`)."""
    return df.withColumns(time_feature_columns(ts))
