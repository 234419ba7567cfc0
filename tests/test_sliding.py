"""Figures put together from two parts of blocks equal those computed per frame, at the same cost for any n."""

import math
import random
import statistics
import time

import pytest
from pyspark.sql import functions as F

from tickloom.operators import indicators as I
from tickloom.operators import sliding

ORDER = ["ts", "id"]


@pytest.fixture(scope="module")
def series():
    """Two keys, a NULL key, gaps of NULL longer than a frame, equal times."""
    rng = random.Random(8)
    rows, i = [], 0
    for key, size in (("a", 700), ("b", 90), (None, 300), ("c", 1)):
        for k in range(size):
            gone = key == "a" and 200 <= k < 420 or rng.random() < 0.1
            rows.append((key, k // 3, i, None if gone else rng.choice([1.0, -2.5, 1e9, rng.uniform(-5, 5)])))
            i += 1
    return rows


@pytest.mark.parametrize("n", [1, 5, 65, 100, 199, 5000])
def test_against_loops(spark, series, n, monkeypatch):
    monkeypatch.setattr(sliding, "NARROW", 0)
    df = spark.createDataFrame(series, "k string, ts long, id long, x double").repartition(5)
    made = sliding.extrema(df, ["k"], ORDER, n, {"low": ("min", "x"), "high": ("max", "x")})
    made = sliding.moments(made, ["k"], ORDER, n, "x", "m")
    assert made.columns == ["k", "ts", "id", "x", "low", "high", "m_n", "m_mean", "m_off"]
    got, seen = {r.id: r for r in made.collect()}, {}
    for key, ts, i, x in series:
        frame = seen.setdefault(key, [])
        frame.append(x)
        there = [v for v in frame[-n:] if v is not None]
        r = got[i]
        assert (r.low, r.high, r.m_n) == (min(there, default=None), max(there, default=None), len(there))
        if there:
            assert math.isclose(r.m_mean, statistics.fmean(there), rel_tol=1e-9, abs_tol=1e-6)
            assert math.isclose(r.m_off, statistics.pvariance(there) * len(there), rel_tol=1e-9, abs_tol=1e-3)
        else:
            assert r.m_mean is None and r.m_off is None


def test_empty(spark):
    df = spark.createDataFrame([], "k string, ts long, id long, x double")
    assert sliding.moments(df, ["k"], ORDER, 100, "x", "m").collect() == []


WIDE = {
    "sma of doubles": (I.sma, {"n": 200, "price": "rate"}),
    "bollinger": (I.bollinger, {"n": 200}),
    "bollinger of doubles": (I.bollinger, {"n": 90, "price": "rate"}),
    "volatility": (I.volatility, {"n": 300}),
    "stochastic": (I.stochastic, {"n": 150, "smooth": 80}),
}


@pytest.mark.parametrize("name", WIDE)
def test_wide_frames_over_chunks(spark, name, monkeypatch):
    """Cut in chunks shorter than a frame, uncut, and computed per frame: all the same."""
    run, how = WIDE[name]
    price = ((F.col("id") * 7919) % 9973 / 100 + 1).cast("decimal(18,4)")
    rows = spark.range(1500).select(
        F.when(F.col("id") % 3 > 0, "HOT").otherwise("S").alias("symbol"), F.floor(F.col("id") / 7).alias("ts"), "id", price.alias("price"),
        price.cast("double").alias("rate"), (price + 3).alias("high"), (price - 1).alias("low"), price.alias("close"),
    ).cache()

    def values(rows_per_task):
        done = run(rows, "symbol", ORDER, rows_per_task=rows_per_task, **how)
        new = [c for c in done.columns if c not in rows.columns]
        return {r[0]: tuple(r[1:]) for r in done.select("id", *[F.round(c, 8) for c in new]).collect()}

    uncut = values(None)
    assert values(60) == uncut and sum(v[-1] is not None for v in uncut.values()) > 300
    monkeypatch.setattr(sliding, "NARROW", 10**9)
    assert values(None) == uncut


def test_cost_does_not_grow_with_n(spark):
    rows = spark.range(0, 300_000, 1, 4).select(F.lit("S").alias("symbol"), "id", ((F.col("id") * 7919) % 9973).cast("double").alias("price"))
    rows = rows.withColumns({"high": F.col("price") + 1, "low": F.col("price") - 1, "close": F.col("price")}).cache()
    rows.count()

    def seconds(n):
        start = time.perf_counter()
        I.stochastic(rows, "symbol", "id", n=n, rows_per_task=None).write.format("noop").mode("overwrite").save()
        I.bollinger(rows, "symbol", "id", n=n, rows_per_task=None).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds(100)
    # per frame, 5,000 rows cost fifty times what 100 do
    assert seconds(5000) < 4 * seconds(100)
