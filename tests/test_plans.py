"""Plans: what must be in them and what must not."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tickloom.operators import indicators, market, validate
from tickloom.plans import catalog
from tickloom.plans import views as V
from tickloom.plans.chain import run_steps
from tickloom.workspace import new_folder, shared_folder

LAZY = [
    name
    for name in catalog.queries()
    if not name.startswith("stream_")
    and "roundtrip" not in name
    and name not in ("append_keeps_duplicates", "key_range_scan", "bulk_load_counts", "snapshot_expiry")
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_row_by_row_python(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in text


def test_aggregates_combine_before_the_shuffle(spark, sf_dir):
    for df in (
        market.ohlcv_daily(V.ticks(spark, sf_dir)),
        market.latest(V.ticks(spark, sf_dir), ["symbol"], "ts", ["trade_id"]),
        validate.dedup_latest(V.ticks(spark, sf_dir), ["symbol"], ["ts"]),
    ):
        assert "partial_" in plan(df)


def test_unique_times_aggregate_by_hash(spark, sf_dir):
    ticks = V.ticks(spark, sf_dir)
    assert "SortAggregate" not in plan(market.ohlcv(ticks, ["symbol"], order=["ts"]))


def test_scan_reads_needed_columns_only(spark, sf_dir):
    text = plan(market.volume(V.daily(spark, sf_dir), "symbol", "date", "quantity"))
    lines = [x for x in text.splitlines() if "FileScan" in x and "l_shipdate" in x]
    assert lines and all("l_extendedprice" not in x and "l_orderkey" not in x for x in lines)


def test_windows_of_one_order_share_shuffle_and_sort(spark, sf_dir):
    df = indicators.rsi(V.ticks(spark, sf_dir), "symbol", ["ts", "trade_id"], rows_per_task=None)
    text = plan(df)
    assert text.count("Exchange hashpartitioning") == 1
    before = text.split("MapInArrow")[1]
    assert "ArrowEvalPython" not in before


def test_steps_run_in_order(spark):
    steps = [lambda d: d.withColumn("x", F.col("id") + 1), lambda d: d.filter("x > 1")]
    assert [r["x"] for r in run_steps(spark.range(3), steps).collect()] == [2, 3]


def test_coverage_and_its_estimate(spark):
    expected = spark.createDataFrame(
        [("d1", "a"), ("d1", "b"), ("d2", "a")], "date string, k string"
    )
    seen = spark.createDataFrame(
        [("d1", "a"), ("d1", "a"), ("d1", "z"), ("d3", "a")], "date string, k string"
    )
    got = {r["date"]: (r["observed"], r["expected"], r["coverage"]) for r in
           market.coverage(expected, seen, "k").collect()}
    assert got == {"d1": (1, 2, 0.5), "d2": (0, 1, 0.0)}
    near = {r["date"]: r["expected"] for r in
            market.approximate_coverage(expected, seen, "k").collect()}
    assert near == {"d1": 2, "d2": 1}
    missing = market.missing_instruments(expected, seen, "k").collect()
    assert sorted((r["date"], r["k"]) for r in missing) == [("d1", "b"), ("d2", "a")]


def test_missing_instruments_of_all_years(spark, tmp_path):
    lines = [(1, "1993-02-03"), (1, "1993-05-01"), (2, "1995-12-31"), (2, "1996-02-01"), (3, "1997-01-01")]
    rows = spark.createDataFrame(lines, "l_partkey long, d string").select("l_partkey", F.to_timestamp_ntz("d").alias("l_shipdate"))
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    found = entry.queries()["missing_instruments"](spark, str(tmp_path)).collect()
    assert sorted((r["instrument"], str(r["date"])) for r in found) == [(1, "1993-03-01"), (1, "1993-04-01"), (2, "1996-01-01")]


def test_folders_are_below_the_shared_one(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    a, b = new_folder(spark, "x"), new_folder(spark, "x")
    assert a != b and a.startswith(folder) and b.startswith(folder)


def test_a_cluster_must_name_its_folder():
    class Conf:
        def get(self, name, default=None):
            return default

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Cluster())


def test_day_summary_is_a_hash_aggregate(spark, sf_dir):
    days = market.ohlcv_daily(V.ticks(spark, sf_dir))
    assert "SortAggregate" not in days._jdf.queryExecution().executedPlan().toString()


def test_order_key_sorts_as_the_columns_do(spark):
    rows = [(t, i) for t in (None, -5, 0, 1_700_000_000_000_000) for i in (None, -(2**63), -1, 0, 7, 2**63 - 1)]
    df = spark.createDataFrame(rows, "us long, id long").select(F.timestamp_micros("us").alias("ts"), "id")
    keyed = df.select("*", market.order_key(df, ["ts", "id"]).alias("k"))
    plain = [tuple(r) for r in keyed.orderBy("ts", "id").select("ts", "id").collect()]
    assert [tuple(r) for r in keyed.orderBy("k").select("ts", "id").collect()] == plain
    assert keyed.select("k").distinct().count() == len(rows)
