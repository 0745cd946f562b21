"""Role resolution and feature derivation edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskframe.functions.names import columns_matching, plain_name
from riskframe.operators.features import add_amount_features, add_time_features, sanitize_target
from riskframe.operators.roles import amount_balance_columns, identity_columns, resolve_event_time
from riskframe.plans.preprocess import build_model_table


def test_normalize_and_substring_overmatch():
    assert plain_name("  Account Balance ") == "account_balance"
    cols = ["Holiday", "Sentiment", "Account_Balance", "Unnamed: 0", "Amount"]
    assert columns_matching(cols, ["id"]) == ["Holiday"]
    assert columns_matching(cols, ["time"]) == ["Sentiment"]
    assert columns_matching(cols, ["id"], match="token") == []


def test_identity_columns_preserve_and_unnamed():
    cols = ["Unnamed: 0", "Customer_ID", "Account_Balance", "Amount", "Is_Fraud", "City"]
    assert identity_columns(cols, "Is_Fraud", ["Account_Balance", "Amount"]) == ["Customer_ID", "Unnamed: 0"]


def test_amount_balance_missing_raises(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError, match="amount"):
        amount_balance_columns(df.schema)


def test_sanitize_target_drops_bad_labels(spark):
    df = spark.createDataFrame([("0",), ("1",), ("1.0",), ("2",), ("x",), (None,), ("NaN",)], "Is_Fraud string")
    assert sorted(r[0] for r in sanitize_target(df, "Is_Fraud").collect()) == [0, 1, 1]


def test_amount_features_nulls_and_zero_division(spark):
    df = spark.createDataFrame([("10", -1.0), ("bad", 5.0), ("-3", None), ("NaN", 1.0)], "amt string, bal double")
    out = add_amount_features(df, "amt", "bal").collect()
    assert out[0]["amount_to_balance_ratio"] is None and out[0]["is_over_balance"] == 1
    assert out[1]["amt"] is None and out[1]["log_amount"] is None and out[1]["is_over_balance"] == 0
    assert out[2]["log_amount"] == 0.0 and out[2]["is_over_balance"] == 0
    assert out[3]["amt"] is None


def test_time_features_missing_time(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 6, 3, 0),), (None,)], "ts timestamp_ntz")
    out = add_time_features(df, F.col("ts")).collect()
    assert (out[0]["tx_hour"], out[0]["tx_day_of_week"], out[0]["is_weekend"], out[0]["is_night"]) == (3, 5, 1.0, 1.0)
    assert out[1]["tx_hour"] is None and out[1]["is_weekend"] == 0.0 and out[1]["is_night"] == 0.0


def test_serial_date_plus_text_time(spark):
    df = spark.createDataFrame([(45292.0, "12:30:00"), (45293.5, "01:00:00")], "Txn_Date double, Txn_Time string")
    ts, rule = resolve_event_time(df)
    got = df.select(ts.alias("t")).collect()
    assert got[0]["t"] == dt.datetime(2024, 1, 1, 12, 30)
    assert got[1]["t"] == dt.datetime(2024, 1, 2, 13, 0)


def test_text_retry_when_parts_do_not_parse(spark):
    df = spark.createDataFrame([("01/05/2024", "10:00"), ("01/06/2024", "11:00")], "Txn_Date string, Txn_Time string")
    ts, rule = resolve_event_time(df)
    assert rule.startswith("text(")
    assert df.select(ts.alias("t")).first()["t"] == dt.datetime(2024, 1, 5, 10, 0)


def test_single_datetime_column(spark):
    df = spark.createDataFrame([("2024-01-02 05:06:07",), ("junk",), ("2024-02-03 00:00:00",)], "Transaction_DateTime string")
    ts, rule = resolve_event_time(df)
    assert rule == "Transaction_DateTime"
    assert df.select(ts.alias("t")).first()["t"] == dt.datetime(2024, 1, 2, 5, 6, 7)


def test_no_datetime_raises(spark):
    df = spark.createDataFrame([("x",)], "Txn_Date string")
    with pytest.raises(ValueError):
        resolve_event_time(df)


def test_model_table_columns(spark):
    from riskframe.sources.fixtures import txn_raw

    mt = build_model_table(txn_raw(spark, "/root/testdata/sf0.001"), row_key="Transaction_ID")
    assert mt.roles.dropped == ["Customer_ID", "Customer_Name", "Transaction_ID"]
    assert mt.categorical == ["Transaction_Type", "Segment", "Nation"]
    assert "Transaction_Date" not in mt.df.columns and mt.df.count() == 981


def test_csv_source_builds_same_model_table(spark, tmp_path):
    from riskframe.sources.fixtures import txn_raw
    from riskframe.sources.tables import read_raw

    raw = txn_raw(spark, "/root/testdata/sf0.001")
    path = str(tmp_path / "raw_csv")
    raw.write.mode("overwrite").option("header", True).csv(path)
    back = read_raw(spark, path, "csv", schema=raw.schema)
    a = build_model_table(raw, row_key="Transaction_ID").df
    b = build_model_table(back, row_key="Transaction_ID").df
    assert a.count() == b.count() == 981
    assert a.exceptAll(b).count() == 0
