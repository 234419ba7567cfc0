"""Cutting hot keys changes no result."""

import pytest
from pyspark.sql import functions as F

from tickloom.operators import indicators as I
from tickloom.operators import monitor as M
from tickloom.operators import ordered as O
from tickloom.operators import validate as C

ORDER = ["ts", "trade_id"]
SIZE = 1500


@pytest.fixture(scope="module")
def ticks(spark):
    """A third of 9000 rows in one key, the rest in small ones, a NULL key among them."""
    spread = F.concat(F.lit("S"), (F.col("id") % 40).cast("string"))
    rows = spark.range(0, 9000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 41 != 0, spread).alias("symbol"),
        F.timestamp_seconds(F.floor(F.col("id") / 7)).alias("ts"),
        F.col("id").alias("trade_id"),
        ((F.col("id") * 7919) % 9973 / 100 + 1).cast("decimal(18,4)").alias("price"),
        ((F.col("id") * 31) % 17).alias("qty"),
    )
    high, low = F.col("price") + F.col("qty"), F.col("price") - F.lit(0.5).cast("decimal(18,4)")
    return rows.withColumns(
        {"high": high, "low": low, "close": F.col("price"), "volume": F.col("qty"), "day": F.to_date("ts")}
    ).cache()


def values(df, columns):
    shown = [
        F.round(c, 9).alias(c) if df.schema[c].dataType.typeName() == "double" else F.col(c)
        for c in columns
    ]
    return {r["trade_id"]: tuple(r[c] for c in columns) for r in df.select("trade_id", *shown).collect()}


CASES = {
    "price_change": (I.price_change, {}),
    "returns": (I.returns, {"n": 10}),
    "sma": (I.sma, {"n": 20}),
    "bollinger": (I.bollinger, {"n": 20}),
    "volatility": (I.volatility, {"n": 20}),
    "stochastic": (I.stochastic, {}),
    "obv": (I.obv, {}),
    "ema": (I.ema, {"n": 12}),
    "rsi": (I.rsi, {"n": 6}),
    "atr": (I.atr, {"n": 6}),
    "macd": (I.macd, {"fast": 4, "slow": 9, "signal": 3}),
}


@pytest.mark.parametrize("name", CASES)
def test_cut_equals_uncut(ticks, name):
    run, how = CASES[name]
    whole = run(ticks, "symbol", ORDER, rows_per_task=None, **how)
    cut = run(ticks, "symbol", ORDER, rows_per_task=SIZE, **how)
    added = [c for c in whole.columns if c not in ticks.columns]
    assert cut.columns == whole.columns and cut.schema == whole.schema
    got, want = values(cut, added), values(whole, added)
    assert got == want and len(got) == 9000


def test_vwap_cut_equals_uncut(ticks):
    whole = values(I.vwap(ticks, "symbol", "day", ORDER, rows_per_task=None), ["vwap"])
    assert values(I.vwap(ticks, "symbol", "day", ORDER, rows_per_task=100), ["vwap"]) == whole


def test_hot_key_is_cut_and_others_are_not(ticks):
    placed = O.ordered(ticks, "symbol", ORDER, SIZE)
    sizes = placed.df.groupBy("symbol", O.CHUNK).count().collect()
    hot = [r["count"] for r in sizes if r["symbol"] == "HOT"]
    assert placed.cut and len(hot) > 1 and max(hot) <= 2 * SIZE and sum(hot) == 3000
    assert all(r[O.CHUNK] is None for r in sizes if r["symbol"] != "HOT")


def test_many_chunks_are_in_order(ticks):
    placed = O.ordered(ticks, "symbol", ORDER, 20)
    chunks = (
        placed.df.filter("symbol = 'HOT'")
        .groupBy(O.CHUNK)
        .agg(F.min("trade_id").alias("a"), F.max("trade_id").alias("b"), F.count("*").alias("n"))
        .orderBy(O.CHUNK)
        .collect()
    )
    assert len(chunks) > 100 and sum(c["n"] for c in chunks) == 3000
    assert [c[O.CHUNK] for c in chunks] == list(range(len(chunks)))
    assert all(x["b"] < y["a"] for x, y in zip(chunks, chunks[1:]))


def test_small_chunks_need_no_tasks_of_their_own(spark):
    """Three thousand chunks out of no more tasks than a shuffle has; equal places stay together."""
    rows = spark.range(6000).select(F.lit("k").alias("symbol"), (F.col("id") - F.col("id") % 3).alias("ts"), F.lit(1).alias("qty"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("cuts", "cuts")
    try:
        placed = O.ordered(rows, "symbol", "ts", 2)
        stages = {s for j in tracker.getJobIdsForGroup("cuts") for s in tracker.getJobInfo(j).stageIds}
        tasks = [i.numTasks for s in stages if (i := tracker.getStageInfo(s))]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sparkContext.setLocalProperty("spark.job.description", None)
    assert tasks and max(tasks) <= max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    found = placed.df.groupBy(O.CHUNK).agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.count("*").alias("n")).orderBy(O.CHUNK).collect()
    assert len(found) > 500 and sum(r["n"] for r in found) == 6000
    assert all(x["b"] < y["a"] for x, y in zip(found, found[1:]))
    starts = placed.starts[("k",)]
    assert [b - a for a, b in zip(starts, starts[1:])] == [r["n"] for r in found[:-1]]


def test_percentiles_of_a_group_in_small_chunks(spark):
    """As in error_rate_hot: values are cut twelve to a chunk, in no more tasks than a shuffle has."""
    rows = spark.range(4000).select(F.lit(1).alias("g"), (F.col("id") % 2000).cast("double").alias("x"))
    firsts, starts = O._cut_points(rows.distinct(), ["g"], ["x"], *O.hot_keys(rows.distinct(), ["g"], 12))
    sizes = [b - a for a, b in zip(starts[(1,)], starts[(1,)][1:])]
    assert len(sizes) > 150 and max(sizes) <= 24 and len(firsts[(1,)]) == len(sizes)
    shares = {"p50": 0.5, "p99": 0.99}
    cut, whole = (M.distribution(rows, ["g"], "x", shares, rows_per_task=n).collect() for n in (12, None))
    assert cut == whole


def test_totals_over_cut_keys(ticks):
    total = {"all": F.col("qty")}
    done = O.ordered(ticks, "symbol", ORDER, 100).running({}, totals=total).result()
    got = {r[0]: (r[1], r[2]) for r in done.groupBy("symbol").agg(F.min("all"), F.max("all")).collect()}
    want = {r[0]: (r[1], r[1]) for r in ticks.groupBy("symbol").agg(F.sum("qty")).collect()}
    assert got == want


@pytest.mark.parametrize("n, rows", [(500, 100), (30, 5)])
def test_look_back_longer_than_chunks(ticks, n, rows):
    """Rows come from as many chunks as it takes."""
    for run in (I.sma, I.volatility):
        whole = run(ticks, "symbol", ORDER, n=n, rows_per_task=None)
        cut = run(ticks, "symbol", ORDER, n=n, rows_per_task=rows)
        added = [c for c in whole.columns if c not in ticks.columns]
        assert values(cut, added) == values(whole, added)


@pytest.fixture(scope="module")
def gaps(ticks):
    """Prices with gaps of 600 in each 1,000 rows of a key, and others that stand still as long."""
    nth = F.col("trade_id") % 3000
    gone = (nth % 1000) < 600
    return ticks.withColumns(
        {
            "gap": F.when(~gone, F.col("price")),
            "flat": F.when(gone, F.lit(7).cast("decimal(18,4)")).otherwise(F.col("price")),
        }
    ).cache()


RECURSIVE = {
    "ema": (I.ema, {"n": 12}, "price"),
    "ema_long": (I.ema, {"n": 200}, "price"),
    "macd": (I.macd, {}, "price"),
    "rsi": (I.rsi, {}, "price"),
    "atr": (I.atr, {}, "close"),
}


@pytest.mark.parametrize("name", RECURSIVE)
@pytest.mark.parametrize("source, rows", [("gap", 40), ("flat", 150)])
def test_recursive_cut_equals_uncut(gaps, name, source, rows):
    run, how, column = RECURSIVE[name]
    data = gaps.withColumn(column, F.col(source)).filter("symbol = 'HOT' OR symbol = 'S7' OR symbol IS NULL")
    whole = run(data, "symbol", ORDER, rows_per_task=None, **how)
    cut = run(data, "symbol", ORDER, rows_per_task=rows, **how)
    assert cut.schema == whole.schema
    added = [c for c in whole.columns if c not in data.columns]
    assert values(cut, added) == values(whole, added)


def test_rsi_of_a_series_that_stands_still(spark):
    rows = [("A", t, float(p)) for t, p in enumerate([5, 6, 5, 7] + [7] * 30_000)]
    flat = spark.createDataFrame(rows, "symbol string, t int, price double")
    for size in (None, 1000):
        got = {r.t: r.rsi for r in I.rsi(flat, "symbol", "t", rows_per_task=size, n=3).collect()}
        assert got[2] is None and 50 < got[3] < 100 and got[40] == pytest.approx(got[3]) and got[29_000] == 50.0
    still = I.rsi(flat.withColumn("price", F.lit(3.0)), "symbol", "t", n=3)
    assert {r[0] for r in still.select("rsi").distinct().collect()} == {None, 50.0}


def test_vwap_keeps_small_prices(spark):
    rows = spark.createDataFrame([("A", 1, 0.00000123, 10), ("A", 2, 0.00000321, 30)], "s string, t int, price double, qty int")
    got = I.vwap(rows, "s", "s", "t").orderBy("t").collect()
    assert [r.vwap for r in got] == pytest.approx([0.00000123, 0.000002715])


def test_long_sums_do_not_overflow(spark):
    rows = spark.createDataFrame([("A", t, 2**62) for t in range(6)], "s string, t int, price long")
    assert [r.sma for r in I.sma(rows, "s", "t", n=2).orderBy("t").collect()][1:] == [float(2**62)] * 5


def test_small_keys_leave_the_plan_alone(ticks):
    placed = O.ordered(ticks, "symbol", ORDER)
    assert placed.df is ticks and not placed.cut


def test_copies_of_a_hot_key(ticks):
    counted = C.count_copies(ticks, ["symbol"])
    got = {r[0]: (r[1], r[2], r[3]) for r in counted.groupBy("symbol").agg(
        F.min(C.COPIES), F.max(C.COPIES), F.count("*")).collect()}
    want = {r[0]: (r[1], r[1], r[1]) for r in ticks.groupBy("symbol").count().collect()}
    assert got == want


def test_rsi_is_bounded(ticks):
    low, high = I.rsi(ticks, "symbol", ORDER).agg(F.min("rsi"), F.max("rsi")).first()
    assert 0 <= low <= high <= 100


def test_recursive_plan_has_one_shuffle_and_one_sort(ticks):
    plan = I.ema(ticks, "symbol", ORDER, rows_per_task=None)
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert text.count("Exchange hashpartitioning") == 1
    assert sum("Sort [" in line for line in text.splitlines()) == 1


def test_series_longer_than_a_batch(spark):
    """State passes from one Arrow batch to the next."""
    n = 25_000
    rows = spark.range(n).select(
        F.lit("A").alias("symbol"), F.col("id").alias("ts"), F.col("id").alias("trade_id"),
        (F.col("id") % 13).cast("decimal(18,4)").alias("price"),
    )
    got = [r[0] for r in I.ema(rows, "symbol", ORDER, n=12).orderBy("ts").select("ema").collect()]
    value, alpha = 0.0, 2 / 13
    for i in range(1, n):
        value += alpha * (i % 13 - value)
        if i % 5000 == 0 or i == n - 1:
            assert got[i] == pytest.approx(value, abs=1e-9)


@pytest.mark.parametrize("kind", ["decimal(18,4)", "double", "bigint"])
def test_moving_average_of_any_type(spark, kind):
    given = [3, None, 5, 7, 9, 11, None, 2, 4, 6]
    rows = spark.createDataFrame(
        [("A", i, x) for i, x in enumerate(given)], "symbol string, t int, x int"
    ).withColumn("x", F.col("x").cast(kind))
    done = I.sma(rows, "symbol", "t", "x", n=3).orderBy("t").collect()
    assert [r["sma"] for r in done] == [None, None, None, None, 7.0, 9.0, None, None, None, 4.0]


def jobs(spark, name, work):
    """What `work` returns and how many jobs it ran."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        done = work()
        return done, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_profile_is_made_once(spark, ticks):
    known, n = jobs(spark, "profile", lambda: O.profile(ticks, "symbol", ORDER, 100))
    assert known.cuts and n >= 2
    for name in ("ema", "sma", "rsi"):
        run, how = CASES[name]
        built, n = jobs(spark, f"build-{name}", lambda: run(ticks, "symbol", ORDER, rows_per_task=known, **how))
        assert n == 0
        added = [c for c in built.columns if c not in ticks.columns]
        assert values(built, added) == values(run(ticks, "symbol", ORDER, rows_per_task=None, **how), added)
    with pytest.raises(ValueError, match="profile"):
        I.ema(ticks, "symbol", ["trade_id"], rows_per_task=known)
