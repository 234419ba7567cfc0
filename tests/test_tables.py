"""Table layout, pruning, append, retention, snapshots, bulk files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tickloom.sources import files, tables

LOADED = "2024-03-10 12:00:00"


def equity(spark, days):
    rows = [("A", d, dt.datetime.combine(d, dt.time(9, i))) for d in days for i in range(3)]
    return spark.createDataFrame(rows, "symbol string, date date, timestamp timestamp")


@pytest.fixture()
def base(spark, tmp_path):
    days = [dt.date(2019, 2, 28), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]
    tables.write_table(equity(spark, days), str(tmp_path), "equity", LOADED)
    return str(tmp_path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_folder_per_month(base):
    months = sorted(n for n in os.listdir(f"{base}/equity") if n.startswith("month="))
    assert months == ["month=201902", "month=202401", "month=202402"]


def test_range_reads_prune_months_and_columns(spark, base):
    rows = tables.read_table(spark, base, "equity", "2024-01-31", "2024-01-31")
    assert rows.count() == 3
    text = plan(rows.select("symbol", "close"))
    assert "month" in text.split("PartitionFilters:")[1].split("]")[0]
    assert "date" in text.split("PushedFilters:")[1].split("]")[0]
    assert "isin" not in text.split("ReadSchema:")[1]


def test_schema_is_declared(spark, base):
    rows = tables.read_table(spark, base, "equity")
    assert rows.schema["close"].dataType.simpleString() == "decimal(18,4)"
    assert rows.columns == tables.TABLES["equity"].columns


def test_load_time_is_the_default(spark, base):
    row = tables.read_table(spark, base, "equity").first()
    assert row["created_at"] == dt.datetime(2024, 3, 10, 12)


def test_append_keeps_equal_rows(spark, base):
    tables.write_table(equity(spark, [dt.date(2024, 2, 1)]), base, "equity", LOADED)
    assert tables.read_table(spark, base, "equity", "2024-02-01").count() == 6


def test_copies_are_spread_and_kept(spark, tmp_path):
    day = dt.date(2024, 2, 1)
    copies = spark.range(0, 4000, 1, 8).select(
        F.lit("A").alias("symbol"),
        F.lit(day).alias("date"),
        F.lit(dt.datetime(2024, 2, 1)).alias("timestamp"),
    )
    arranged = tables.arrange(tables.apply_defaults(copies, "equity", LOADED), "equity", files=4)
    sizes = [r["count"] for r in arranged.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 and len(sizes) == 4


def test_rows_per_file(spark, tmp_path):
    rows = equity(spark, [dt.date(2024, 2, 1)])
    tables.write_table(rows, str(tmp_path), "equity", LOADED, files=1, rows_per_file=1)
    parts = list((tmp_path / "equity" / "month=202402").glob("load=*/*.parquet"))
    assert len(parts) == 3


def test_retention_edges(spark):
    rows = spark.createDataFrame(
        [(dt.date(2020, 2, 28),), (dt.date(2020, 2, 29),), (dt.date(2020, 3, 1),)], "date date"
    )
    # 29 February plus five years is 28 February.
    kept = [r[0] for r in tables.retain(rows, "equity", "2025-02-28").collect()]
    assert kept == [dt.date(2020, 3, 1)]
    short = [r[0] for r in tables.retain(rows, "equity", "2021-02-27", 365).collect()]
    assert short == [dt.date(2020, 2, 29), dt.date(2020, 3, 1)]


def test_whole_months_expire(spark, base):
    assert tables.expire_months(spark, base, "equity", "2024-03-10") == ["month=201902"]
    assert tables.read_table(spark, base, "equity").count() == 6
    assert tables.expire_months(spark, base, "equity", "2024-03-10") == []


def test_metrics_month_is_exchange_month(spark, tmp_path):
    rows = spark.createDataFrame(
        [("m", 1.0, {"a": "b"}, dt.datetime(2024, 1, 31, 20, 0))],
        "metric_name string, metric_value double, labels map<string,string>, timestamp timestamp",
    )
    tables.write_table(rows, str(tmp_path), "system_metrics", LOADED)
    assert os.path.isdir(tmp_path / "system_metrics" / "month=202402")
    back = tables.read_table(spark, str(tmp_path), "system_metrics", "2024-02-01", "2024-02-01")
    assert back.first()["labels"] == {"a": "b"}
    assert "timestamp" in plan(back).split("PushedFilters:")[1].split("]")[0]
    assert tables.read_table(spark, str(tmp_path), "system_metrics", "2024-02-02").count() == 0
    assert tables.read_table(spark, str(tmp_path), "system_metrics", end="2024-01-31").count() == 0


def test_scan_and_retention_reach_the_files(spark, base):
    rows = tables.read_table(spark, base, "equity")
    found = tables.scan(rows, "equity", "A", "2024-01-31 09:01:00", "2024-02-01 09:01:00")
    assert [r["timestamp"].minute for r in found.collect()] == [1, 2, 0]
    pushed = plan(found).split("PushedFilters:")[1].split("]")[0]
    assert "symbol" in pushed and "timestamp" in pushed
    kept = tables.retain(rows, "equity", "2024-03-10")
    assert kept.count() == 6
    assert "GreaterThanOrEqual(date" in plan(kept)
    pruned = tables.read_kept(spark, base, "equity", "2024-03-10")
    assert pruned.count() == 6
    assert "month" in plan(pruned).split("PartitionFilters:")[1].split("]")[0]
    assert tables.read_kept(spark, base, "equity", "2025-02-01", override_days=365).count() == 0
    assert tables.read_kept(spark, base, "equity", "2025-01-30", override_days=365).count() == 3


def test_snapshots(spark, tmp_path):
    rows = spark.range(3)
    path = str(tmp_path / "s")
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        files.write_snapshot(rows, path, day)
    assert files.read_snapshots(spark, path, rows.schema).count() == 6
    assert files.read_snapshots(spark, path, rows.schema, "2024-01-31").count() == 3
    assert files.expire_snapshots(spark, path, "2024-01-31") == ["snapshot=202401010000"]


def test_bulk_json_keeps_bad_rows(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"symbol": "A", "n": 1}\n{"symbol": broken\n')
    schema = spark.createDataFrame([], "symbol string, n bigint").schema
    rows = files.bulk_load(spark, str(tmp_path), "json", schema).collect()
    assert sorted((r["symbol"] or "", r["_corrupt"] or "") for r in rows) == [
        ("", '{"symbol": broken'),
        ("A", ""),
    ]


def test_a_load_replaces_itself_and_months_are_compacted(spark, tmp_path):
    base, rows = str(tmp_path), equity(spark, [dt.date(2024, 2, 1), dt.date(2024, 3, 1)])
    tables.write_table(rows, base, "equity", LOADED)
    for _ in range(2):
        tables.write_load(rows, base, "equity", LOADED, "stream-0")
    n = rows.count()
    assert tables.read_table(spark, base, "equity").count() == 2 * n
    for month in (202402, 202403):
        tables.compact_month(spark, base, "equity", month)
        assert len(list((tmp_path / "equity" / f"month={month}").glob("load=*"))) == 1
    assert tables.read_table(spark, base, "equity").count() == 2 * n


def test_layout_by_size_keeps_all_rows(spark, tmp_path):
    rows = equity(spark, [dt.date(2024, 2, 1), dt.date(2024, 3, 1)])
    tables.write_table(rows, str(tmp_path), "equity", LOADED, by_size=True)
    assert tables.read_table(spark, str(tmp_path), "equity").count() == rows.count()
    plan = tables.arrange(tables.apply_defaults(rows, "equity", LOADED), "equity", by_size=True)
    assert "REBALANCE_PARTITIONS_BY_COL" in plan._jdf.queryExecution().executedPlan().toString()


class Broken(Exception):
    pass


@pytest.mark.parametrize("at", range(1, 12))
def test_a_compaction_that_breaks_off_changes_no_row(spark, tmp_path, monkeypatch, at):
    """At each write and each delete of a second compaction."""
    base = str(tmp_path)
    rows = spark.createDataFrame([("A", "2024-01-02 10:00:00", 1.5)], "symbol string, timestamp string, close double").withColumn("timestamp", F.to_timestamp("timestamp"))
    for n in range(3):
        tables.write_load(rows, base, "equity", "2024-01-03", f"batch-{n}")
    read = lambda: tables.read_table(spark, base, "equity").count()
    tables.compact_month(spark, base, "equity", 202401)
    assert read() == 3
    for n in range(3, 6):
        tables.write_load(rows, base, "equity", "2024-01-03", f"batch-{n}")
    calls = [0]
    with monkeypatch.context() as m:
        for name in ("delete_folder", "write_text"):
            def run(*args, own=getattr(tables, name)):
                calls[0] += 1
                if calls[0] == at:
                    raise Broken
                return own(*args)

            m.setattr(tables, name, run)
        try:
            tables.compact_month(spark, base, "equity", 202401)
        except Broken:
            pass
    assert read() == 6
    tables.compact_month(spark, base, "equity", 202401)
    assert read() == 6
    loads = [p.name for p in (tmp_path / "equity" / "month=202401").glob("load=*")]
    assert len(loads) == 1 and loads[0].startswith("load=merged-")
    tables.write_load(rows, base, "equity", "2024-01-03", "batch-9")
    assert read() == 7
