"""Role resolution by column name (P2-P5, P10) and the parse-rate job.

Everything here but :func:`resolve_event_time` works on the schema alone, on the driver, and returns
names.  The event timestamp needs one small aggregation (share of rows each candidate parses) - a
single ``agg`` over all candidate expressions at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.names import columns_matching, plain_name

TARGET = "Is_Fraud"

# Keyword lists and explicit names of the reference's role detection.
AMOUNT_KEYWORDS = ("amount",)
BALANCE_KEYWORDS = ("balance",)
DATE_KEYWORDS = ("date",)
TIME_KEYWORDS = ("time",)
DATETIME_KEYWORDS = ("datetime", "timestamp")
DATETIME_LIKE_KEYWORDS = ("date", "time", "datetime", "timestamp")
IDENTITY_KEYWORDS = ("id", "name", "account", "email", "contact", "phone", "description")
IDENTITY_EXPLICIT = (
    "transaction_id", "customer_id", "merchant_id", "account_number",
    "customer_name", "customer_email", "customer_contact",
)

# Text forms a date or date-time column may take; ISO forms are read by a plain cast first.
# One fixed list replaces format guessing (a stated narrowing): month-first before day-first.
TEXT_TIMESTAMP_FORMATS = (
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "M/d/yyyy",
    "d-M-yyyy H:mm:ss",
    "d-M-yyyy",
)
EXCEL_EPOCH = "1899-12-30 00:00:00"

PARSE_THRESHOLD = 0.5


@dataclass
class Roles:
    target: str
    amount: str
    balance: str
    event_time: str  # how the timestamp was built, for the manifest
    date_like: list[str] = field(default_factory=list)
    dropped: list[str] = field(default_factory=list)


def amount_balance_columns(schema: T.StructType, match: str = "substring") -> tuple[str, str]:
    """First ``amount`` column and first ``balance`` column; a clear error if either is absent."""
    names = schema.fieldNames()
    found = {role: next(iter(columns_matching(names, words, match)), None)
             for role, words in (("amount", AMOUNT_KEYWORDS), ("balance", BALANCE_KEYWORDS))}
    absent = [role for role, name in found.items() if name is None]
    if absent:
        raise ValueError(f"no column name stands for {' or '.join(absent)} in {names}")
    return found["amount"], found["balance"]


def identity_columns(columns: Sequence[str], target: str, preserve: Sequence[str] = (), match: str = "substring") -> list[str]:
    """P5: identifying columns to drop, sorted.  Never the target nor a preserved column."""

    def identifies(name: str) -> bool:
        plain = plain_name(name)
        return plain.startswith("unnamed") or plain in IDENTITY_EXPLICIT or bool(columns_matching([name], IDENTITY_KEYWORDS, match))

    return sorted({c for c in set(columns) - {target, *preserve} if identifies(c)})


def drop_identity(df: DataFrame, target: str, preserve: Sequence[str] = (), match: str = "substring") -> tuple[DataFrame, list[str]]:
    """P5 on a DataFrame: the dropped columns never reach the scan (column pruning)."""
    cols = identity_columns(df.columns, target, preserve, match)
    return df.drop(*cols), cols


def feature_column_kinds(schema: T.StructType, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """P10: numeric and categorical model columns by type; booleans, dates and the rest are dropped."""
    skip = set(exclude)
    numeric = [f.name for f in schema.fields if f.name not in skip and isinstance(f.dataType, T.NumericType)]
    categorical = [f.name for f in schema.fields if f.name not in skip and isinstance(f.dataType, T.StringType)]
    return numeric, categorical


# ---------------------------------------------------------------------------------------------
# Event timestamp


def _text_timestamp(s: Column) -> Column:
    parsed = [s.try_cast("timestamp_ntz")]
    parsed += [F.try_to_timestamp(s, F.lit(fmt)).cast("timestamp_ntz") for fmt in TEXT_TIMESTAMP_FORMATS]
    return F.coalesce(*parsed)


def _serial_day(x: Column) -> Column:
    micros = F.round(x.cast("double") * F.lit(86_400_000_000.0)).cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, F.lit(EXCEL_EPOCH).cast("timestamp_ntz"))


def timestamp_expr(df: DataFrame, col: str) -> Column:
    """A column parsed as a date-time: typed values cast, numbers read as serial day numbers, text parsed."""
    dt = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp_ntz")
    if isinstance(dt, T.NumericType):
        return _serial_day(c)
    return _text_timestamp(c.cast("string"))


def time_of_day_expr(df: DataFrame, col: str) -> Column:
    """Text time of day as a day-time interval; unparseable text gives NULL."""
    dt = df.schema[col].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        ts = F.col(col).cast("timestamp_ntz")
        return ts - F.date_trunc("day", ts).cast("timestamp_ntz")
    return F.col(col).cast("string").try_cast("interval hour to second")


def event_time_candidates(df: DataFrame, match: str = "substring") -> tuple[str, list[tuple[str, Column]]]:
    """Candidate expressions for the event timestamp, in the order they are tried, and the rule kind.

    Kind ``date+time``: [date + time of day, joined text]; kind ``single``: one per candidate column.
    """
    cols = df.columns
    date_cols = columns_matching(cols, DATE_KEYWORDS, match)
    time_cols = columns_matching(cols, TIME_KEYWORDS, match)
    dt_cols = columns_matching(cols, DATETIME_KEYWORDS, match)
    if date_cols and time_cols and date_cols[0] != time_cols[0]:
        d, t = date_cols[0], time_cols[0]
        text = F.concat_ws(" ", F.col(d).cast("string"), F.col(t).cast("string"))
        return "date+time", [
            (f"{d} + {t}", timestamp_expr(df, d) + time_of_day_expr(df, t)),
            (f"text({d} {t})", _text_timestamp(text)),
        ]
    # One column named both date and time (e.g. *Transaction_DateTime*) is a date-time column.
    seen: list[str] = []
    for c in dt_cols + date_cols + time_cols:
        if c not in seen:
            seen.append(c)
    return "single", [(c, timestamp_expr(df, c)) for c in seen]


def parse_rates(df: DataFrame, candidates: list[tuple[str, Column]]) -> dict[str, float]:
    """Share of rows each candidate parses, all in one aggregation job."""
    if not candidates:
        return {}
    aggs = [F.avg(expr.isNotNull().cast("int")).alias(f"_r{i}") for i, (_, expr) in enumerate(candidates)]
    row = df.agg(*aggs).first()
    return {name: (row[f"_r{i}"] or 0.0) for i, (name, _) in enumerate(candidates)}


def resolve_event_time(df: DataFrame, match: str = "substring") -> tuple[Column, str]:
    """The event timestamp expression and the rule that produced it.

    Date and time columns: date + time of day if more than half the rows parse, else the joined text by the same test.
    Otherwise the first date-time / date / time candidate with more than half the rows parsing.  Raises where none is.
    """
    _, cands = event_time_candidates(df, match)
    if not cands:
        raise ValueError(f"no column name stands for a date or time in {df.columns}")
    rates = parse_rates(df, cands)
    for name, expr in cands:
        if rates[name] > PARSE_THRESHOLD:
            return expr, name
    raise ValueError(f"none of the time rules applies: {[n for n, _ in cands]}")


def date_like_columns(columns: Sequence[str], match: str = "substring") -> list[str]:
    """Columns named like a date or time: preserved from the identity drop, removed after P8."""
    return columns_matching(columns, DATETIME_LIKE_KEYWORDS, match)
