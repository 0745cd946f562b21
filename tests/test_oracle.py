"""Every registered query with oracle SQL agrees with DuckDB on the sf0.001 tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from riskframe.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
SLOW = {"fit_boosted", "fit_forest", "grouped_training", "adaptive_training"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind in "fiu" or str(df[c].dtype).startswith(("Int", "Float")):
            df[c] = df[c].astype("float64").round(6)
        elif df[c].dtype.kind == "M":
            df[c] = df[c].astype("datetime64[us]")
    df = df.astype(object).where(pd.notna(df), None)
    return df.sort_values(list(df.columns), key=lambda s: s.astype(str)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got = _norm(entry.queries()[name](spark, SF).toPandas())
    want = _norm(duck.sql(entry.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    pd.testing.assert_frame_equal(got.astype(str), want.astype(str))


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() == 1


def test_every_query_has_a_callable():
    qs = entry.queries()
    assert set(entry.oracle_sql()) <= set(qs)
