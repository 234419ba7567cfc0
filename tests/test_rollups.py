"""Figures per hour and bitmaps per load add up to those of all rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import market as K
from tickloom.operators import rollups as U


@pytest.fixture(scope="module")
def rows(spark):
    """A group with most rows, skewed values, NULL values and groups, one row alone."""
    skewed = F.exp(F.randn(3) * 3)
    made = spark.range(0, 200_000, 1, 5).select(
        F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, F.concat(F.lit("g"), F.col("id") % 13)).alias("name"),
        F.when(F.col("id") % 11 > 0, skewed).alias("value"),
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 3).alias("timestamp"),
    )
    return made.unionByName(spark.createDataFrame([("one", 4.5, dt.datetime(2024, 2, 1)), ("none", None, dt.datetime(2024, 2, 1))], made.schema)).cache()


@pytest.mark.parametrize("k", [200, 800])
def test_merged_sketches_keep_their_error(rows, k):
    days = U.merge_rollups(U.rollup(rows, ["name"], "value", k=k), ["name"], "1 day", k)
    whole = days.groupBy("name").agg(F.sum("n").alias("n"), F.min("min_value"), F.max("max_value"), F.round(F.sum("sum_value"), 3))
    want = rows.where("value IS NOT NULL").groupBy("name").agg(F.count("*").alias("n"), F.min("value"), F.max("value"), F.round(F.sum("value"), 3))
    assert sorted(map(str, whole.collect())) and {tuple(r) for r in whole.collect()} == {tuple(r) for r in want.collect()}
    bound = 3 * U.RANK_ERROR * U.SKETCH_K / k
    by_day = rows.withColumn("bucket", F.window("timestamp", "1 day")["start"])
    for share in (0.0, 0.01, 0.5, 0.95, 0.999, 1.0):
        off = U.rank_off(by_day, U.with_percentiles(days, {"p": share}), ["name", "bucket"], "value", "p", share)
        worst = off.join(days.select("name", "bucket", "n"), on=(off["name"].eqNullSafe(days["name"])) & (off["bucket"] == days["bucket"])).agg(F.max(F.col("rank_off") - 1 / F.col("n"))).first()[0]
        assert worst <= bound


def test_one_and_no_value(spark, rows):
    one = U.with_percentiles(U.rollup(rows.where("name IN ('one', 'none')"), ["name"], "value"), {"p": 0.3}).collect()
    assert [(r.name, r.n, r.min_value, r.avg_value, r.p) for r in one] == [("one", 1, 4.5, 4.5, 4.5)]
    assert U.merge_rollups(U.rollup(rows.limit(0), ["name"], "value"), ["name"], "1 day").collect() == []


def test_rank_off(spark):
    rows = spark.createDataFrame([("a", float(v)) for v in (1, 2, 2, 2, 3)], "g string, v double")
    for pick, share, want in ((2.0, 0.5, 0), (2.0, 0.2, 0), (3.0, 0.5, 0.3), (1.0, 0.5, 0.3)):
        picked = spark.createDataFrame([("a", pick)], "g string, p double")
        assert U.rank_off(rows, picked, ["g"], "v", "p", share).first().rank_off == pytest.approx(want)


def test_bitmaps_of_loads(spark):
    """Copies in a load and over loads, numbers over several buckets, rows without a number or day."""
    rng = random.Random(2)
    day = lambda n: dt.date(2024, 1, 1 + n)
    rows = [(rng.choice([1, 2, 32_768, 32_769, 70_000, rng.randint(1, 200_000)]), day(rng.randrange(6))) for _ in range(3000)]
    loads = [rows[:900], rows[700:2000] * 3, rows[1500:], [(None, day(1)), (3, None)], []]
    parts = [U.seen_bitmaps(spark.createDataFrame(load, "n long, date date"), "n") for load in loads]
    merged = parts[0]
    for p in parts[1:]:
        merged = U.merge_bitmaps(merged.unionByName(p))
    got = {r.date: r.observed for r in U.seen_per_day(merged).collect()}
    assert got == {d: len({n for n, x in rows if x == d}) for d in {x for _, x in rows}}


def test_coverage_by_bitmap_is_that_by_spans(spark):
    rng = random.Random(4)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    listed = spark.createDataFrame([(k, day(rng.randrange(5)), day(5 + rng.randrange(20))) for k in range(1, 40)] + [(7, day(1), day(3))], "k long, first date, last date")
    seen = spark.createDataFrame([(rng.randrange(1, 45), day(rng.randrange(-3, 30))) for _ in range(800)], "k long, date date")
    inside = K.within_span(seen, listed, "k")
    got = U.coverage_by_bitmap(K.expected_per_period(listed, "k"), U.seen_bitmaps(inside, "k"))
    want = K.coverage_by_span(listed, seen, "k")
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}


def test_expected_instruments_of_a_range(spark):
    day = lambda n: dt.date(2024, 1, n)
    listed = spark.createDataFrame([(1, day(2), day(9)), (2, day(8), day(9)), (3, day(1), day(3))], "k long, first date, last date")
    got = K.expected_instruments(listed, "k", "first", "last", since="2024-01-03", until="2024-01-05")
    assert sorted((r.k, r.date.day) for r in got.collect()) == [(1, 3), (1, 4), (1, 5), (3, 3)]
    assert K.expected_instruments(listed, "k", "first", "last").count() == 8 + 2 + 3
