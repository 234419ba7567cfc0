"""Streams over several batches: state, lateness, restarts, batch size."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.operators import indicators as I
from tickloom.plans import views as V
from tickloom.schemas import RAW_EQUITY
from tickloom.operators.normalize import normalize_equity
from tickloom.sources import feeds, tables
from tickloom.streaming import partials, sinks, state, windows


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    return V.table(spark, sf_dir, "events")


def land(events, path, bounds):
    """One file after the other, so that batches come in this order."""
    for low, high in bounds:
        part = events.filter((F.col("event_id") >= low) & (F.col("event_id") < high))
        part.coalesce(1).write.mode("append").parquet(path)


def run(stream, out, checkpoint):
    writer = stream.writeStream.format("parquet").option("path", out)
    query = feeds.paced(writer.option("checkpointLocation", checkpoint), None).start()
    query.awaitTermination()
    return query


def thirds(events):
    n = events.count()
    return [(0, n // 3), (n // 3, 2 * n // 3), (2 * n // 3, n)]


def in_thirds(events):
    """Bounds of event time of three parts, one after the other."""
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    cuts = [low + (high - low) * k / 3 for k in range(4)]
    return [(F.col("ts") >= a) & (F.col("ts") < b) for a, b in zip(cuts, [*cuts[1:3], high + dt.timedelta(1)])]


def land_where(events, path, parts):
    for part in parts:
        events.filter(part).coalesce(1).write.mode("append").parquet(path)


@pytest.fixture()
def stateful(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    state.use_state_store(session)
    return session


@pytest.mark.parametrize("at_once", [7, 10_000])
def test_ema_in_state_equals_batch(stateful, events, tmp_path, at_once):
    """Prices with gaps, rows in no order inside a batch; only those of the last bucket and hour are not told yet."""
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    gap = F.when(F.col("trade_id") % 3 > 0, F.col("price")).alias("price")
    change = lambda rows: V.as_ticks(rows).select("symbol", "ts", "trade_id", gap)
    land_where(events.orderBy(F.xxhash64("event_id")), landing, in_thirds(events))
    stream = feeds.feed(stateful, landing, events.schema, "parquet", files_per_batch=1)
    query = run(state.stream_ema(change(stream), at_once=at_once), out, str(tmp_path / "cp"))
    assert len({p["batchId"] for p in query.recentProgress if p["numInputRows"]}) == 3
    want = I.ema(change(events), "symbol", ["ts", "trade_id"])
    over = events.agg(F.max("ts")).first()[0] - dt.timedelta(hours=2)
    want = {r.trade_id: (r.ts, r.ema) for r in want.collect()}
    got = {r.trade_id: (r.ts, r.ema) for r in stateful.read.parquet(out).collect()}
    assert {i for i, (ts, _) in want.items() if ts <= over} <= set(got) <= set(want) and len(got) < len(want)
    for i, (ts, mean) in got.items():
        assert ts == want[i][0] and (mean == pytest.approx(want[i][1], abs=1e-9) if mean is not None else want[i][1] is None)


def test_late_rows_stay_out_of_the_state(stateful, events, tmp_path):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    first, second, third = in_thirds(events)
    land_where(events, landing, [second, first, third])
    run(state.stream_ema(V.as_ticks(feeds.feed(stateful, landing, events.schema, "parquet", files_per_batch=1))), out, str(tmp_path / "cp"))
    assert stateful.read.parquet(out).select("ts").filter(first).count() == 0


def test_previous_rows_and_copies_over_batches(stateful, tmp_path):
    """As windows over all rows give them: ties, copies in other batches, NULL keys, times and values."""
    import random

    rng = random.Random(7)
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    at = lambda minute: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)
    schema = "k string, t timestamp, n int, kind string, x decimal(10,2), seen timestamp"
    rows = [(rng.choice(["a", "b", None]), at(rng.randrange(600)), n, rng.choice(["u", None]), rng.choice([None, *range(5)]), at(n)) for n in range(400)]
    rows = sorted(rows, key=lambda r: r[1]) + [("a", None, 900, "u", 1, at(0)), ("a", at(900), 901, "u", 2, None)]
    typed = stateful.createDataFrame([(*r[:4], None if r[4] is None else __import__("decimal").Decimal(r[4]), r[5]) for r in rows], schema)
    for a, b in ((0, 150), (150, 290), (290, 403)):
        part = rows[a:b] + [r for r in rows[max(0, a - 5) : a] if r[1] and a]  # some come again in the next batch, within the lateness
        again = {r[2] for r in rows[a:b]} | {r[2] for r in part}
        typed.where(F.col("n").isin(sorted(again))).coalesce(1).write.mode("append").parquet(landing)
    stream = feeds.feed(stateful, landing, schema, "parquet", files_per_batch=1)
    told = state.with_previous(stream, "k", "t", ["n"], {"before": "x", "then": "seen"}, ["kind"], lateness=dt.timedelta(minutes=200), at_once=9)
    run(told, out, str(tmp_path / "cp"))
    from pyspark.sql import Window

    everything = stateful.read.schema(schema).parquet(landing)
    w, like = Window.partitionBy("k").orderBy("t", "n"), Window.partitionBy("k", "t", "kind")
    want = everything.where("t IS NOT NULL").select("*", F.lag("x").over(w).alias("before"), F.lag("seen").over(w).alias("then"), F.count("*").over(like).alias("copies"))
    over = at(900) - dt.timedelta(minutes=200)
    want = sorted(map(str, want.where(F.date_trunc("hour", "t") + F.expr("INTERVAL 1 HOUR") <= F.lit(over)).collect()))
    got = stateful.read.parquet(out)
    assert got.where("t IS NULL").select("n", "before", "copies").collect() == [(900, None, 1)]
    assert sorted(map(str, got.where("t IS NOT NULL").collect())) == want and len(want) > 300


def outages_of(beats, limit, over):
    told = []
    for key in {k for k, _ in beats}:
        own = sorted(t for k, t in beats if k == key)
        for t, then in zip(own, [*own[1:], None]):
            if then is None or then > t + limit:
                told += [(key, "down", t + limit)] + ([(key, "up", then)] if then else [])
    return sorted(x for x in told if x[2] <= over)


def test_outages(stateful, tmp_path):
    """Heartbeats out of order within the lateness, repeated, at the limit to the microsecond, NULLs."""
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    at = lambda minute, us=0: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute, microseconds=us)
    batches = [
        [("a", at(0)), ("a", at(30)), ("a", at(10)), ("b", at(5)), ("b", at(5)), ("c", at(0)), (None, at(3)), ("d", None)],
        [("a", at(20)), ("b", at(15)), ("c", at(10, 1)), ("b", at(38))],  # within half an hour of the newest
        [("a", at(100)), ("b", at(47, 999)), ("e", at(101))],
        [("a", at(400))],
    ]
    schema, limit = "k string, t timestamp", dt.timedelta(minutes=10)
    for n, rows in enumerate(batches):
        stateful.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        stream = feeds.feed(stateful, landing, schema, "parquet", files_per_batch=1)
        run(state.outages(stream, "k", "t", limit, dt.timedelta(minutes=30)), out, str(tmp_path / "cp"))
        got = sorted(map(tuple, stateful.read.parquet(out).collect()))
        here = [r for b in batches[: n + 1] for r in b if None not in r]
        assert got == outages_of(here, limit, max(t for _, t in here) - dt.timedelta(minutes=30))


def test_spans():
    import random

    rng = random.Random(1)
    for _ in range(200):
        spans, points = [], set()
        for _ in range(rng.randint(1, 12)):
            begin = rng.randrange(60)
            until = begin + rng.randint(1, 9)
            state.merge_span(spans, begin, until)
            points |= {x / 2 for x in range(2 * begin, 2 * until + 1)}
        assert spans == sorted(spans) and {x / 2 for b, u in spans for x in range(2 * b, 2 * u + 1)} == points
        assert all(u < b for (_, u), (b, _) in zip(spans, spans[1:]))


class _Store:
    """A processor's state and timers, counted."""

    def __init__(self):
        self.spans, self.since, self.timers, self.now = [], None, set(), 0

    def getListState(self, *_):
        store = self

        class Spans:
            get = staticmethod(lambda: iter(store.spans))
            put = staticmethod(lambda spans: store.__setattr__("spans", list(spans)))
            clear = staticmethod(lambda: store.__setattr__("spans", []))

        return Spans

    def getValueState(self, *_):
        store = self

        class Down:
            exists = staticmethod(lambda: store.since is not None)
            get = staticmethod(lambda: store.since)
            update = staticmethod(lambda v: store.__setattr__("since", v))
            clear = staticmethod(lambda: store.__setattr__("since", None))

        return Down

    def registerTimer(self, ms):
        self.timers.add(ms)

    def getCurrentWatermarkInMs(self):
        return self.now


def test_outages_take_one_timer_of_a_key():
    """Two hundred outages in a batch are told by one call, in any order of heartbeats."""
    import random
    from types import SimpleNamespace

    store, limit = _Store(), 10_000
    watch = state._Watch(limit, ["k", "event", "moment"])
    watch.init(store)
    beats = [1_000_000 + 50_000 * n for n in range(201)]
    random.Random(1).shuffle(beats)
    told, calls = [], 0
    for part, now in ((beats[:150], 1500), (beats[150:], 20_000)):
        list(watch.handleInputRows(("a",), [SimpleNamespace(at=b) for b in part if b > store.now * 1000], store))
        store.now = now
        while due := sorted(t for t in store.timers if t <= now):
            store.timers -= set(due[:1])
            told += list(watch.handleExpiredTimer(("a",), store, None))
            calls += 1
        assert len(store.timers) <= 1
    assert calls <= 4
    seen = [b for b in beats[:150]] + [b for b in beats[150:] if b > 1_500_000]
    want = outages_of([("a", dt.datetime.fromtimestamp(b / 1e6, dt.UTC)) for b in seen], dt.timedelta(microseconds=limit), dt.datetime.fromtimestamp(20, dt.UTC))
    assert sorted((r[1], r[2]) for r in told) == [(e, round(t.timestamp() * 1e6)) for _, e, t in want]
    assert [r[2] for r in told] == sorted(r[2] for r in told)


def test_newest_rows_shrink_before_the_shuffle(stateful, tmp_path):
    """A stream without an end of life needs no call to Python for a key."""
    rows = feeds.feed(stateful, str(tmp_path), "k string, t timestamp, id long", "parquet")
    plan = lambda **how: state.newest_rows(rows, ["k"], "t", ["id"], **how)._jdf.queryExecution().logical().toString()
    (tmp_path / "x").mkdir()
    assert "max_by" in plan() and "TransformWithState" not in plan()
    assert "TransformWithState" in plan(ttl=dt.timedelta(days=1))


@pytest.mark.parametrize("salts", [1, 5])
def test_newest_rows_are_in_the_state(stateful, tmp_path, salts):
    """Ties, NULL times and keys, a hot key, old rows that come late, a batch that changes nothing."""
    landing, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    schema = "k string, t timestamp, id long, x decimal(10,2)"
    day = lambda n: dt.datetime(2024, 1, n)
    D = __import__("decimal").Decimal
    batches = [
        [("a", day(2), 1, D("1.50")), ("a", day(2), 3, D("2.50")), ("b", None, 1, None), (None, day(1), 5, D("0.01"))],
        [("a", day(1), 9, D("9.00")), ("b", day(1), None, D("3.00"))] + [("hot", day(3), n, D(n)) for n in range(500)],
        [("hot", day(3), 7, D("7.00")), ("a", day(2), 2, None)],
    ]
    how = ["k"], "t", ["id"]
    for n, rows in enumerate(batches):
        stateful.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        stream = state.newest_rows(feeds.feed(stateful, landing, schema, "parquet", files_per_batch=1), *how, salts=salts)
        feeds.paced(stream.writeStream.format("noop").outputMode("update").option("checkpointLocation", cp), None).start().awaitTermination()
        best = {}
        for r in [r for b in batches[: n + 1] for r in b]:
            place = tuple((v is not None, v or day(1)) if j == 0 else (v is not None, v or 0) for j, v in enumerate(r[1:3]))
            best[r[0]] = max(best.get(r[0], (place, r)), (place, r), key=lambda x: x[0])
        got = {r.k: tuple(r) for r in state.read_newest(stateful, cp, *how, stateful.createDataFrame([], schema).schema).collect()}
        assert got == {k: r for k, (_, r) in best.items()}


@pytest.mark.parametrize("size", [10**6, 150])
def test_running_ema_over_batches(spark, events, tmp_path, size):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    n = events.count()
    # The last part repeats the time of the first: all of it is late.
    land(events, landing, thirds(events))
    land(events, landing, [(0, n // 10)])
    ticks = V.as_ticks(feeds.feed(spark, landing, events.schema, "parquet", files_per_batch=1))
    handle = sinks.running_ema(out, n=3, rows_per_task=size)
    sinks.each_batch(ticks, handle, str(tmp_path / "cp")).awaitTermination()
    rows = spark.read.parquet(f"{out}/rows")
    assert rows.groupBy("batch").count().count() == 4
    late = rows.filter("is_late")
    assert late.filter("batch = 3").count() == late.count() == n // 10
    assert late.filter("ema is not null").count() == 0
    want = I.ema(V.as_ticks(events), "symbol", ["ts", "trade_id"], n=3)
    both = rows.filter("not is_late").join(
        want.select("trade_id", F.col("ema").alias("want")), "trade_id"
    )
    assert both.count() == n
    assert both.filter(F.abs(F.col("ema") - F.col("want")) > 1e-9).count() == 0


def test_messages(spark):
    sent = spark.createDataFrame([(bytearray(b'{"symbol": "A", "open": 1.5}'),), (bytearray(b"{bad"),)], "value binary")
    rows = feeds.read_messages(sent, RAW_EQUITY).collect()
    assert [(r["symbol"], r["open"], r["_corrupt"]) for r in rows] == [
        ("A", "1.5", None),
        (None, None, "{bad"),
    ]


def test_bars_over_batches(spark, events, tmp_path):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    land(events, landing, thirds(events))
    ticks = V.as_ticks(feeds.feed(spark, landing, events.schema, "parquet", files_per_batch=1))
    run(windows.stream_bars(ticks), out, str(tmp_path / "cp"))
    bars = spark.read.parquet(out)
    end = events.agg(F.max("ts")).first()[0] - dt.timedelta(hours=1)
    want = windows.bars(V.as_ticks(events), "1 hour").filter(
        F.col("bar") + F.expr("INTERVAL 1 HOUR") <= F.lit(end)
    )
    assert bars.count() == want.count() > 0
    assert bars.exceptAll(want.select(*bars.columns)).count() == 0
    assert bars.filter("low > open or low > close or high < open or high < close").count() == 0


def test_restart_adds_no_row_twice(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()

    def ingest():
        records = feeds.feed(spark, str(landing), RAW_EQUITY, files_per_batch=1)
        feeds.ingest(
            normalize_equity(records), str(tmp_path), "equity", str(tmp_path / "cp"), "2024-01-03"
        ).awaitTermination()
        return tables.read_table(spark, str(tmp_path), "equity")

    line = '{"symbol": "A", "close": 1.5, "timestamp": "2024-01-02T10:00:00+05:30"}\n'
    (landing / "1.json").write_text(line * 2)
    assert ingest().count() == 2
    assert ingest().count() == 2
    (landing / "2.json").write_text(line)
    rows = ingest()
    assert rows.count() == 3
    assert rows.select("date").distinct().first()[0] == dt.date(2024, 1, 2)


def test_batches_are_bounded_by_files(spark, tmp_path):
    landing = str(tmp_path / "in")
    spark.range(60).repartition(6).write.parquet(landing)
    sizes = []
    stream = feeds.feed(
        spark, landing, spark.range(0).schema, "parquet", files_per_batch=2
    )
    sinks.each_batch(
        stream, lambda df, n: sizes.append(df.count()), str(tmp_path / "cp")
    ).awaitTermination()
    assert len(sizes) == 3 and sum(sizes) == 60


def test_repeated_batch_leaves_the_same_result(spark, tmp_path):
    path = str(tmp_path)
    schema = "k string, ts timestamp, id bigint"
    first = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1)], schema)
    second = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 2), 2), ("b", dt.datetime(2024, 1, 1), 3)], schema
    )
    keep = sinks.keep_latest(path + "/latest", ["k"], "ts", ["id"])
    late = sinks.split_late(path + "/late", "1 HOUR", "ts")
    for _ in range(2):
        keep(first, 0)
        late(first, 0)
    for _ in range(2):
        keep(second, 1)
        late(second, 1)
    rows = sinks.read_latest(spark, path + "/latest", first.schema).collect()
    assert sorted((r["k"], r["id"]) for r in rows) == [("a", 2), ("b", 3)]
    counts = sinks.late_counts(spark, path + "/late", schema).orderBy("batch").collect()
    assert [(r["rows"], r["late_rows"]) for r in counts] == [(1, 0), (2, 0)]
    old = spark.createDataFrame([("a", dt.datetime(2023, 1, 1), 9)], schema)
    late(old, 2)
    keep(old, 2)
    rows = sinks.read_latest(spark, path + "/latest", first.schema).collect()
    assert sorted((r["k"], r["id"]) for r in rows) == [("a", 2), ("b", 3)]
    assert {r["late_rows"] for r in sinks.late_counts(spark, path + "/late", schema).collect()} == {0, 1}


@pytest.mark.parametrize("as_folder", [False, True])
def test_no_row_is_lost_whatever_the_order(spark, events, tmp_path, as_folder):
    """Windows and first rows over a table kept as a file or as a folder, read out of order."""
    source, n = tmp_path / "data", events.count()
    source.mkdir()
    if as_folder:
        land(events, str(source / "events.parquet"), [(2 * n // 3, n), (0, n // 3), (n // 3, 2 * n // 3)])
    else:
        events.coalesce(1).write.parquet(str(tmp_path / "one"))
        part = next((tmp_path / "one").glob("part-*.parquet"))
        (source / "events.parquet").write_bytes(part.read_bytes())
    stream = V.as_ticks(feeds.feed(spark, f"{source}/events.parquet*", events.schema, "parquet", files_per_batch=1))
    bars, seen = str(tmp_path / "bars"), str(tmp_path / "seen")
    sinks.each_batch(stream, partials.windows_to(bars), str(tmp_path / "cp1")).awaitTermination()
    sinks.each_batch(stream, partials.first_seen_to(seen), str(tmp_path / "cp2")).awaitTermination()
    for _ in range(2):  # before and after a compaction
        got = partials.read_windows(spark, bars).withColumnRenamed("window_start", "bar")
        want = windows.bars(V.as_ticks(events), "1 hour")
        columns = ["symbol", "bar", "open", "high", "low", "close", "volume", "trades"]
        assert got.count() == want.count() and got.select(columns).exceptAll(want.select(columns)).count() == 0
        partials.compact(spark, bars)
    assert spark.read.parquet(f"{seen}/first").count() == n and spark.read.parquet(f"{seen}/again").count() == 0


def test_repeated_batch_leaves_one_result(spark, events, tmp_path):
    out = str(tmp_path / "out")
    for handle in (partials.windows_to(out), partials.first_seen_to(f"{out}/ids")):
        for number in (0, 1, 1):
            half = events.filter(F.col("event_id") % 2 == number)
            handle(V.as_ticks(half), number)
    assert partials.read_windows(spark, out).agg(F.sum("trades")).first()[0] == events.count()
    assert spark.read.parquet(f"{out}/ids/first").count() == events.count()


def test_versions(spark, tmp_path):
    with pytest.raises(ValueError, match="two versions"):
        sinks.keep_latest(str(tmp_path), ["k"], "ts", ["id"], keep=1)
    assert sinks.read_latest(spark, str(tmp_path / "none"), "k int, ts timestamp").count() == 0


def test_untouched_buckets_are_not_rewritten(spark, tmp_path):
    path = str(tmp_path / "latest")
    handle = sinks.keep_latest(path, ["k"], "ts", ["id"], buckets=8)
    row = lambda k, t: (k, dt.datetime(2024, 1, 1, t), t)
    schema = "k long, ts timestamp, id long"
    handle(spark.createDataFrame([row(k, 1) for k in range(50)], schema), 0)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "latest").glob("version=0/bucket=*/*.parquet")}
    for number in (1, 1, 2):  # one of them twice
        handle(spark.createDataFrame([row(7, 1 + number), row(7, 0)], schema), number)
    assert len(list((tmp_path / "latest" / "version=2").glob("bucket=*"))) == 1
    left = {p: p.stat().st_mtime_ns for p in (tmp_path / "latest").glob("version=0/bucket=*/*.parquet")}
    assert len(left) == len(before) - 1 and all(before[p] == t for p, t in left.items())
    got = {r.k: r.id for r in sinks.read_latest(spark, path, schema).collect()}
    assert got == {k: 3 if k == 7 else 1 for k in range(50)}


def test_another_number_of_buckets_is_refused(spark, tmp_path):
    schema = "k long, ts timestamp, id long"
    rows = spark.createDataFrame([(k, dt.datetime(2024, 1, 1), k) for k in range(20)], schema)
    sinks.keep_latest(str(tmp_path), ["k"], "ts", ["id"], buckets=8)(rows, 0)
    with pytest.raises(ValueError, match="8 buckets, not 16"):
        sinks.keep_latest(str(tmp_path), ["k"], "ts", ["id"], buckets=16)(rows, 1)
    assert sinks.read_latest(spark, str(tmp_path), schema).count() == 20


def test_first_rows_without_a_time(spark, tmp_path):
    """Rows without a time are compared with each other, over batches; a repeated batch changes nothing."""
    schema = "trade_id long, ts timestamp, x string"
    at = dt.datetime(2024, 1, 1, 5)
    handle = partials.first_seen_to(str(tmp_path))
    batches = [[(1, None, "a"), (2, at, "b"), (None, None, "c")], [(1, None, "d"), (1, at, "e"), (None, None, "f")], [(3, None, "g"), (1, None, "h"), (2, at, "i")]]
    for n in (0, 0, 1, 1, 2, 2):
        handle(spark.createDataFrame(batches[n], schema), n)
    assert {r.x for r in spark.read.parquet(f"{tmp_path}/first").collect()} == set("abceg")
    assert {r.x for r in spark.read.parquet(f"{tmp_path}/again").collect()} == set("dfhi")


def test_first_rows_open_their_own_days(spark, tmp_path):
    """The folders that a batch opens do not grow with the batches before it."""
    handle = partials.first_seen_to(str(tmp_path))
    opened, found = [], partials.subfolders

    def counting(session, path):
        opened[-1] += len(names := found(session, path))
        return names

    partials.subfolders = counting
    try:
        for n in range(6):
            opened.append(0)
            handle(spark.createDataFrame([(k, dt.datetime(2024, 1, 1 + n, 3)) for k in range(5)], "trade_id long, ts timestamp"), n)
    finally:
        partials.subfolders = found
    assert set(opened) == {0}
    opened = [0]
    handle(spark.createDataFrame([(1, dt.datetime(2024, 1, 2, 3)), (9, dt.datetime(2024, 1, 2, 3))], "trade_id long, ts timestamp"), 6)
    assert spark.read.parquet(f"{tmp_path}/first/batch=6").count() == 1


class Broken(Exception):
    pass


def breaking(monkeypatch, module, names, at):
    """Let the `at`-th of all calls of these functions of a module fail."""
    calls = [0]
    for name in names:
        def run(*args, own=getattr(module, name), **more):
            calls[0] += 1
            if calls[0] == at:
                raise Broken
            return own(*args, **more)

        monkeypatch.setattr(module, name, run)
    return calls


@pytest.mark.parametrize("at", range(1, 9))
def test_a_compaction_that_breaks_off_changes_nothing(spark, events, tmp_path, monkeypatch, at):
    out = str(tmp_path)
    handle = partials.windows_to(out)
    for n in range(5):
        handle(V.as_ticks(events.filter(F.col("event_id") % 5 == n)), n)
    want = {tuple(r) for r in partials.read_windows(spark, out).collect()}
    partials.compact(spark, out)
    handle(V.as_ticks(events.filter("event_id < 0")), 5)
    handle(V.as_ticks(events.filter("event_id < 0")), 6)
    with monkeypatch.context() as m:
        calls = breaking(m, partials, ["delete_folder", "put"], at)
        try:
            partials.compact(spark, out)
        except Broken:
            pass
    assert calls[0] >= min(at, 5)
    assert {tuple(r) for r in partials.read_windows(spark, out).collect()} == want
    partials.compact(spark, out)
    assert {tuple(r) for r in partials.read_windows(spark, out).collect()} == want
