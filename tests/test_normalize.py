"""Sample records, typing, keys and extras."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickloom.operators import normalize as N
from tickloom.schemas import RAW_DERIVATIVES, RAW_EQUITY

# One record of each feed.
EQUITY = {
    "symbol": "RELIANCE", "series": "EQ", "open": 2500.0, "high": 2550.0, "low": 2480.0,
    "close": 2520.0, "last": 2520.0, "prevClose": 2510.0, "tottrdqty": 1000000,
    "tottrdval": 2520000000.0, "timestamp": "2023-09-27T14:30:00+05:30", "totaltrades": 45000,
}
DERIVATIVE = {
    "symbol": "RELIANCE", "expiryDate": "2023-10-26", "instrumentType": "FUTIDX",
    "strikePrice": 0.0, "optionType": "", "open": 2505.0, "high": 2555.0, "low": 2485.0,
    "close": 2525.0, "last": 2525.0, "prevClose": 2515.0, "volume": 500000,
    "value": 1262500000.0, "openInterest": 2000000, "changeInOI": 50000,
    "timestamp": "2023-09-27T14:30:00+05:30",
}


def one(spark, record, schema):
    return spark.createDataFrame([tuple(record.get(f) for f in schema.names)], schema)


def test_equity_sample(spark):
    row = N.normalize_equity(one(spark, EQUITY, RAW_EQUITY)).first()
    assert row["symbol"] == "RELIANCE" and row["isin"] is None
    assert row["prev_close"] == Decimal("2510.0000")
    assert row["total_traded_quantity"] == 1000000
    assert row["total_traded_value"] == Decimal("2520000000.00")
    assert row["total_trades"] == 45000
    assert row["timestamp"] == dt.datetime(2023, 9, 27, 9, 0)
    assert row["date"] == dt.date(2023, 9, 27)
    assert row["type_errors"] == []


def test_derivative_sample(spark):
    rows = N.normalize_derivatives(one(spark, DERIVATIVE, RAW_DERIVATIVES))
    row = rows.first()
    assert row["expiry_date"] == dt.date(2023, 10, 26)
    assert row["strike_price"] == Decimal("0.0000") and row["option_type"] == ""
    assert row["value"] == Decimal("1262500000.00")
    assert (row["open_interest"], row["change_in_oi"]) == (2000000, 50000)
    clean = N.canonical_keys(rows).first()
    assert clean["strike_price"] is None and clean["option_type"] is None


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_trading_day_does_not_depend_on_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        raw = spark.createDataFrame([("2023-09-28T02:00:00+05:30",)], "t string")
        row = N.parse_event_time(raw, "t").select("date", F.unix_micros("timestamp")).first()
        assert row[0] == dt.date(2023, 9, 28)
        assert row[1] == 1695846600 * 1_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_milliseconds_are_kept_and_microseconds_cut(spark):
    raw = spark.createDataFrame([("2023-09-27T14:30:00.123987+05:30",), ("bad",)], "t string")
    rows = N.parse_event_time(raw, "t").collect()
    assert rows[0]["timestamp"] == dt.datetime(2023, 9, 27, 9, 0, 0, 123000)
    assert rows[1]["timestamp"] is None and rows[1]["date"] is None


def test_values_that_do_not_fit_are_named(spark):
    raw = spark.createDataFrame(
        [("x", "abc", "1.00005", "99999999999999999999", None)],
        "symbol string, open string, close string, total_traded_quantity string, high string",
    )
    row = N.apply_types(raw, "equity").first()
    assert row["open"] is None and row["total_traded_quantity"] is None
    assert row["close"] == Decimal("1.0001")
    assert sorted(row["type_errors"]) == ["open", "total_traded_quantity"]


def test_extra_wins(spark):
    df = spark.createDataFrame(
        [({"a": "1", "b": "2"}, {"b": "9", "c": "3"}), ({"a": "1"}, None)],
        "computed map<string,string>, extra map<string,string>",
    )
    got = df.select(N.merge_extra(F.col("computed"), F.col("extra"))).collect()
    assert got[0][0] == {"a": "1", "b": "9", "c": "3"}
    assert got[1][0] == {"a": "1"}


def test_threshold(spark):
    df = spark.createDataFrame([("debug",), ("Info",), ("ERROR",), ("odd",)], "log_level string")
    kept = [r[0] for r in N.logs_at_or_above(df, "info").collect()]
    assert kept == ["Info", "ERROR"]
    with pytest.raises(ValueError):
        N.logs_at_or_above(df, "loud")
