"""Rules on hand-made rows, and properties of cleansing."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tickloom.operators import validate as C
from tickloom.operators.normalize import normalize_equity
from tickloom.schemas import DERIVATIVES, EQUITY, RAW_EQUITY
from tickloom.sources.files import bulk_load

T0 = dt.datetime(2024, 1, 2, 4)


def equity(spark, **changes):
    row = dict(
        symbol="A", series="EQ", date=T0.date(), timestamp=T0, open=Decimal(10), high=Decimal(12),
        low=Decimal(9), close=Decimal(11), last=Decimal(11), prev_close=Decimal(10),
        total_traded_quantity=100, total_traded_value=Decimal(1100), total_trades=5, isin=None,
        created_at=T0,
    )
    row.update(changes)
    df = spark.createDataFrame([tuple(row[c] for c in EQUITY.columns)], EQUITY.schema)
    return C.validate(df, C.table_rules("equity")).first()["reasons"]


def test_equity_rules(spark):
    assert equity(spark) == []
    assert equity(spark, symbol=" ") == ["required"]
    assert equity(spark, timestamp=None) == ["required"]
    assert equity(spark, total_trades=-1) == ["range"]
    assert equity(spark, total_trades=2**32) == ["range"]
    assert equity(spark, total_trades=2**32 - 1) == []
    assert equity(spark, low=Decimal("10.5")) == ["price_bounds"]
    assert equity(spark, total_traded_value=Decimal(1300)) == ["value"]
    assert equity(spark, total_traded_quantity=0) == ["value"]
    assert equity(spark, total_traded_quantity=0, total_traded_value=Decimal(0)) == []
    assert equity(spark, close=Decimal(-1)) == ["range", "price_bounds"]
    assert equity(spark, open=None, last=None) == []


def derivative(spark, kind, strike, option):
    row = {c: None for c in DERIVATIVES.columns}
    row.update(symbol="A", instrument_type=kind, strike_price=strike, option_type=option, timestamp=T0)
    df = spark.createDataFrame([tuple(row[c] for c in DERIVATIVES.columns)], DERIVATIVES.schema)
    return C.validate(df, C.table_rules("derivatives")).first()["reasons"]


def test_legs(spark):
    assert derivative(spark, "FUTIDX", Decimal(0), "") == []
    assert derivative(spark, "FUTSTK", None, None) == []
    assert derivative(spark, "FUTSTK", Decimal(5), None) == ["leg"]
    assert derivative(spark, "FUTSTK", None, "CE") == ["leg"]
    assert derivative(spark, "OPTSTK", Decimal(5), "PE") == []
    assert derivative(spark, "OPTSTK", Decimal(0), "PE") == ["leg"]
    assert derivative(spark, "OPTSTK", Decimal(5), None) == ["leg"]


def test_index_rules_need_no_value(spark):
    assert "value" not in C.table_rules("indices")


def test_derived_percent(spark):
    rows = spark.createDataFrame(
        [("i", 1, "100", "0", "0"), ("i", 2, "110", "10", "10"), ("i", 3, "99", "-11", "-9")],
        "k string, t int, close string, points_change string, percent_change string",
    )
    typed = rows.withColumns(
        {c: F.col(c).cast("decimal(18,4)") for c in ("close", "points_change", "percent_change")}
    )
    got = {r["t"]: r["derived_fails"] for r in C.check_derived(typed, "k", "t").collect()}
    assert got == {1: False, 2: False, 3: True}


def test_split_loses_nothing_and_counts(spark):
    rows = C.validate(spark.range(100), {"odd": F.col("id") % 2 == 1, "small": F.col("id") < 10})
    good, bad = C.split_valid(rows)
    assert good.count() + bad.count() == 100 and good.count() == 45
    summary = {r["rule"]: r["rows_failed"] for r in C.rule_summary(rows).collect()}
    assert summary == {"odd": 50, "small": 10}
    watched, seen = C.observe_quality(rows, "quality")
    watched.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 100, "rows_failed": 55}


def test_dedup_is_idempotent_and_takes_newest(spark):
    rows = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, 1), ("a", 2, 3), ("b", 1, None), (None, 1, 1), (None, 1, 1)],
        "k string, t int, x int",
    )
    once = C.dedup_latest(rows, ["k"], ["t"])
    assert sorted(once.collect(), key=str) == sorted(
        C.dedup_latest(once, ["k"], ["t"]).collect(), key=str
    )
    assert {tuple(r) for r in once.collect()} == {("a", 2, 3), ("b", 1, None), (None, 1, 1)}


def test_latest_of_rows_with_maps(spark):
    rows = [("m", 1, {"a": "1"}), ("m", 2, {"b": "2", "a": "0"}), ("m", 2, {"a": "0", "b": "1"}), ("n", 1, None)]
    df = spark.createDataFrame(rows, "metric_name string, t int, labels map<string,string>")
    got = {r.metric_name: (r.t, r.labels) for r in C.dedup_latest(df, ["metric_name"], ["t"]).collect()}
    assert got == {"m": (2, {"a": "0", "b": "2"}), "n": (1, None)}


def test_feed_rules_name_what_could_not_be_read(spark, tmp_path):
    (tmp_path / "f.json").write_text('{"symbol": "A", "timestamp": "2024-01-02T10:00:00+05:30", "open": "abc", "high": 1, "low": 1, "close": 1, "tottrdqty": "many"}\n{"symbol": \n')
    rows = C.validate(normalize_equity(bulk_load(spark, str(tmp_path), "json", RAW_EQUITY)), C.feed_rules("equity")).collect()
    assert sorted((r.symbol or "", r.type_errors, r.reasons) for r in rows) == [
        ("", ["_corrupt"], ["required", "unreadable"]), ("A", ["open", "total_traded_quantity"], ["required", "unreadable"]),
    ]
