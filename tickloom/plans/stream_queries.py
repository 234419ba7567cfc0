"""Streaming queries: each runs its stream over what is there, and returns what the sink holds.

A stream gets a session of its own, in which the number of state partitions follows the cores
there are: every one of them keeps a state store.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import rules as R
from tickloom.functions.timing import plain
from tickloom.operators import monitor as M
from tickloom.operators import validate as C
from tickloom.plans import clean_queries as Q
from tickloom.plans import views as V
from tickloom.plans.registry import query
from tickloom.plans.views import sql
from tickloom.sources import frames
from tickloom.sources.feeds import feed, paced
from tickloom.streaming import metrics, partials, sinks, state
from tickloom.workspace import new_folder


def _stream_session(spark: SparkSession) -> SparkSession:
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    cores = spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(cores))
    state.use_state_store(session)
    return session


def _events(spark: SparkSession, folder: str) -> DataFrame:
    """The table as a stream, be it one file or a folder of files."""
    schema = V.table(spark, folder, "events").schema
    return feed(_stream_session(spark), f"{folder}/events.parquet*", schema, "parquet")


def _collected(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Run an append-mode stream to its end into files and read them."""
    out, checkpoint = new_folder(spark, name), new_folder(spark, "progress")
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
    )
    paced(writer, None).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def _turned(spark: SparkSession, folder: str, turns: list[Column], change, mode: str, name: str) -> tuple[str, str]:
    """Run a changed stream of events over the turns, each a batch; its output and its checkpoint.

    Output of append mode is kept as files; in update mode what counts is the state.
    """
    landing, out, checkpoint = (new_folder(spark, x) for x in ("landing", name, "progress"))
    events = V.table(spark, folder, "events")
    for turn in turns:
        events.filter(turn).write.mode("append").parquet(landing)
        stream = change(feed(_stream_session(spark), landing, events.schema, "parquet"))
        writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        writer = writer.format("parquet").option("path", out) if mode == "append" else writer.format("noop")
        paced(writer, None).start().awaitTermination()
    return out, checkpoint


def _in_turns(
    spark: SparkSession, folder: str, turns: list[Column], handle: Callable[[DataFrame, int], None], change
) -> None:
    """Land the events of each condition after those of the one before, each turn one batch."""
    landing, checkpoint = new_folder(spark, "landing"), new_folder(spark, "progress")
    events = V.table(spark, folder, "events")
    for turn in turns:
        events.filter(turn).write.mode("append").parquet(landing)
        stream = change(feed(_stream_session(spark), landing, events.schema, "parquet"))
        sinks.each_batch(stream, handle, checkpoint).awaitTermination()


@query("SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, event_type, value FROM events")
def stream_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Events as messages in frames, landed in three turns and read by a stream that goes on where it ended."""
    landing, out, checkpoint = (new_folder(spark, x) for x in ("landing", "messages", "progress"))
    frames.register(spark)  # sessions made from another one do not find its sources; nothing here has state
    events = V.table(spark, folder, "events")
    fields = F.struct("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts"), "event_type", "value")
    shape = "event_id bigint, ts bigint, event_type string, value double"
    for turn in _in_time():
        messages = events.where(turn).select(F.to_json(fields).cast("binary").alias("value"))
        messages.write.format("frames").mode("append").save(landing)
        read = spark.readStream.format("frames").load(landing).select(F.from_json(F.col("value").cast("string"), shape).alias("m")).select("m.*")
        writer = read.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        paced(writer, None).start().awaitTermination()
    return spark.read.schema(shape).parquet(out).withColumn("ts", plain(F.timestamp_micros("ts")))


#: Newest events first, then parts that overlap in time: most rows are late by any watermark.
def _out_of_order() -> list[Column]:
    k = F.col("event_id")
    return [k % 4 == 3, (k % 4 != 3) & (k % 3 == 0), (k % 4 < 2) & (k % 3 != 0), (k % 4 == 2) & (k % 3 != 0)]


@query(
    sql(
        """
SELECT symbol, bar, open, high, low, close, volume, CAST(value AS DECIMAL(28,4)) AS value, trades
FROM hour_bars""",
        "hour_bars",
    )
)
def stream_bars(spark: SparkSession, folder: str) -> DataFrame:
    """All bars of events that arrive in four batches out of order."""
    out = new_folder(spark, "bars")
    _in_turns(spark, folder, _out_of_order(), partials.windows_to(out), V.as_ticks)
    done = partials.read_windows(spark, out)
    return done.select(
        "symbol", plain(F.col("window_start")).alias("bar"), "open", "high", "low", "close", "volume",
        F.col("value").cast("decimal(28,4)").alias("value"), "trades",
    )


@query(
    sql(
        """
WITH placed AS (
  SELECT symbol, price, qty,
         time_bucket(INTERVAL 15 MINUTE, ts) - to_minutes(unnest([0, 15, 30, 45])) AS window_start
  FROM ticks)
SELECT symbol, window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS trades,
       CAST(sum(qty) AS BIGINT) AS volume,
       round(CAST(sum(price) AS DOUBLE) / count(*), 6) AS avg_price
FROM placed
GROUP BY symbol, window_start""",
        "ticks",
    )
)
def stream_sliding(spark: SparkSession, folder: str) -> DataFrame:
    """Sliding figures of events that arrive out of order, after a compaction in between."""
    out = new_folder(spark, "sliding")
    _in_turns(spark, folder, _out_of_order(), partials.windows_to(out, "1 hour", "15 minutes"), V.as_ticks)
    partials.compact(spark, out)
    done = partials.read_windows(spark, out)
    average = F.col("price_sum").cast("double") / F.col("trades")
    return done.select(
        "symbol", plain(F.col("window_start")).alias("window_start"), plain(F.col("window_end")).alias("window_end"),
        "trades", "volume", F.round(average, 6).alias("avg_price"),
    )


_TWICE_SQL = "SELECT symbol, ts, price, qty, trade_id, user_id FROM ticks"


def _sent_twice(spark: SparkSession, folder: str, part: str) -> DataFrame:
    """Every event comes twice, within a batch and in batches out of order; some come a third time."""
    out = new_folder(spark, "dedup")
    turns = _out_of_order()

    def change(events: DataFrame) -> DataFrame:
        twice = events.withColumn("_sent", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_sent")
        return V.as_ticks(twice)

    _in_turns(spark, folder, [*turns, turns[1]], partials.first_seen_to(out), change)
    schema = V.ticks(spark, folder).schema
    done = spark.read.schema(schema).parquet(f"{out}/{part}").select(*schema.names)
    return done.withColumn("ts", plain(F.col("ts")))


@query(sql(_TWICE_SQL, "ticks"))
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return _sent_twice(spark, folder, "first")


@query(
    sql(
        f"""
{_TWICE_SQL}
UNION ALL SELECT symbol, ts, price, qty, trade_id, user_id FROM ticks WHERE trade_id % 4 <> 3 AND trade_id % 3 = 0
UNION ALL SELECT symbol, ts, price, qty, trade_id, user_id FROM ticks WHERE trade_id % 4 <> 3 AND trade_id % 3 = 0""",
        "ticks",
    )
)
def stream_dedup_again(spark: SparkSession, folder: str) -> DataFrame:
    """The copies: with the first ones they are all that came."""
    return _sent_twice(spark, folder, "again")


@query(
    """
WITH parts AS (SELECT ts, CAST(user_id % 2 AS BIGINT) AS batch FROM events),
newest AS (SELECT max(ts) FILTER (batch = 0) AS mark FROM parts)
SELECT batch, count(*) AS rows,
       count(*) FILTER (batch = 1 AND ts < mark - INTERVAL 1 HOUR) AS late_rows
FROM parts, newest GROUP BY batch"""
)
def stream_late(spark: SparkSession, folder: str) -> DataFrame:
    """Users with even numbers arrive first; most rows of the others are late by then."""
    out = new_folder(spark, "late")
    turns = [F.col("user_id") % 2 == part for part in (0, 1)]
    _in_turns(spark, folder, turns, sinks.split_late(out, "1 HOUR"), V.as_ticks)
    schema = "symbol string, ts timestamp, trade_id bigint"
    return sinks.late_counts(spark, out, schema)


_EMA_SQL = sql(
    """
WITH numbered AS (
  SELECT trade_id, symbol, CAST(price AS DOUBLE) AS p,
         row_number() OVER (PARTITION BY symbol ORDER BY ts, trade_id) AS place
  FROM ticks),
chain AS (
  SELECT trade_id, symbol, place, p AS ema FROM numbered WHERE place = 1
  UNION ALL
  SELECT t.trade_id, t.symbol, t.place, c.ema + (2::DOUBLE / 13) * (t.p - c.ema)
  FROM chain c JOIN numbered t ON t.symbol = c.symbol AND t.place = c.place + 1)
SELECT trade_id, symbol, round(ema, 6) AS ema, false AS is_late FROM chain""",
    "ticks",
    recursive=True,
)


@query(_EMA_SQL)
def stream_ema(spark: SparkSession, folder: str) -> DataFrame:
    out, checkpoint = new_folder(spark, "ema"), new_folder(spark, "progress")
    stream = V.as_ticks(_events(spark, folder))
    sinks.each_batch(stream, sinks.running_ema(out, buckets=8), checkpoint).awaitTermination()
    done = spark.read.schema(
        f"trade_id bigint, symbol string, ema double, {sinks.LATE} boolean"
    ).parquet(f"{out}/rows")
    return done.select("trade_id", "symbol", F.round("ema", 6).alias("ema"), sinks.LATE)


def _in_time() -> list[Column]:
    """Three batches, each wholly after the one before; in no order inside."""
    return [F.dayofmonth("ts") <= 9, F.dayofmonth("ts").between(10, 19), F.dayofmonth("ts") > 19]


#: Buckets of an hour that end an hour or more before the last row; watermarks and timers are in milliseconds.
_TOLD = """epoch_ms(date_trunc('hour', ts) + INTERVAL 1 HOUR)
  <= (SELECT epoch_ms(max(ts)) - 3600000 FROM ticks)"""


@query(_EMA_SQL.replace("round(ema, 6) AS ema, false AS is_late FROM chain", f"round(ema, 6) AS ema FROM chain JOIN ticks USING (trade_id, symbol) WHERE {_TOLD}"))
def stream_ema_state(spark: SparkSession, folder: str) -> DataFrame:
    """The same figure out of Spark's own state, for all rows that event time has passed."""
    stream = lambda events: state.stream_ema(V.as_ticks(events))
    out, _ = _turned(spark, folder, _in_time(), stream, "append", "ema")
    done = spark.read.schema("trade_id bigint, symbol string, ema double").parquet(out)
    return done.select("trade_id", "symbol", F.round("ema", 6).alias("ema"))


@query(
    """
WITH beats AS (
  SELECT user_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next FROM events),
told AS (
  SELECT user_id, 'down' AS event, ts + INTERVAL 6 HOUR AS moment FROM beats WHERE next IS NULL OR next > ts + INTERVAL 6 HOUR
  UNION ALL
  SELECT user_id, 'up', next FROM beats WHERE next > ts + INTERVAL 6 HOUR)
SELECT * FROM told WHERE epoch_us(moment) <= (SELECT (epoch_ms(max(ts)) - 3600000) * 1000 FROM events)"""
)
def stream_stale(spark: SparkSession, folder: str) -> DataFrame:
    """Users that send nothing for six hours are down until they send again; told by timers."""
    stream = lambda events: state.outages(events.withColumn("ts", F.col("ts").cast("timestamp")), "user_id", "ts", timedelta(hours=6))
    out, _ = _turned(spark, folder, _in_time(), stream, "append", "outages")
    told = spark.read.schema("user_id bigint, event string, moment timestamp").parquet(out)
    return told.withColumn("moment", plain(F.col("moment")))


@query(
    sql(
        """
SELECT trade_id, concat_ws(',', CASE WHEN qty = 0 THEN 'traded' END,
                           CASE WHEN price > 100 THEN 'range' END) AS reasons
FROM ticks""",
        "ticks",
    )
)
def stream_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Valid rows, with no reason, and quarantined rows of a stream."""
    out, checkpoint = new_folder(spark, "checked"), new_folder(spark, "progress")
    stream = V.as_ticks(_events(spark, folder)).select("trade_id", "price", "qty")
    sinks.each_batch(stream, sinks.quarantine_to(out, _trade_rules()), checkpoint).awaitTermination()
    valid = spark.read.schema("trade_id bigint").parquet(f"{out}/valid")
    bad = spark.read.schema(f"trade_id bigint, {C.REASONS} array<string>").parquet(
        f"{out}/quarantine"
    )
    return valid.select("trade_id", F.lit("").alias(C.REASONS)).unionByName(
        bad.select("trade_id", F.array_join(C.REASONS, ",").alias(C.REASONS))
    )


def _trade_rules() -> dict[str, Column]:
    return {"traded": F.col("qty") == 0, "range": R.out_of_range("price", upper={"price": 100})}


@query(
    sql(
        """
WITH marked AS (
  SELECT CASE WHEN day(ts) <= 9 THEN 0 WHEN day(ts) <= 19 THEN 1 ELSE 2 END AS turn,
         qty = 0 OR price > 100 AS failed FROM ticks)
SELECT row_number() OVER (ORDER BY turn) - 1 AS batch, count(*) AS records_processed,
       count(*) FILTER (failed) AS rows_failed, round(1 - count(*) FILTER (failed) / count(*), 6) AS success_rate,
       CASE WHEN count(*) FILTER (failed) / count(*) > 0.05 THEN 'error' WHEN count(*) FILTER (failed) / count(*) > 0.01 THEN 'warning' ELSE 'info' END AS severity
FROM marked GROUP BY turn""",
        "ticks",
    )
)
def stream_batch_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """What each batch's rows were while they passed, without reading them again."""
    landing, out, path, checkpoint = (new_folder(spark, x) for x in ("landing", "checked", "metrics", "progress"))
    events, session = V.table(spark, folder, "events"), _stream_session(spark)
    listener = metrics.attach(session, path, "trades")
    for turn in _in_time():
        events.filter(turn).write.mode("append").parquet(landing)
        checked = C.validate(V.as_ticks(feed(session, landing, events.schema, "parquet")), _trade_rules())
        writer = metrics.watched(checked, "trades").writeStream.format("parquet").option("path", out)
        paced(writer.option("checkpointLocation", checkpoint), None).start().awaitTermination()
    metrics.detach(listener)
    done = metrics.read_metrics(spark, path)
    steady = done.withColumns({"processing_time": F.lit(0.001), "exact": F.col("success_rate")})  # speed is not compared
    return M.batch_metrics(steady).select("batch", "records_processed", "rows_failed", F.round("exact", 6).alias("success_rate"), "severity")


@query(
    sql(
        f"""
SELECT source, mark, copy, {Q.REASONS_SQL} AS reasons FROM failures
WHERE epoch_ms(date_trunc('hour', timestamp) + INTERVAL 1 HOUR) <= (SELECT epoch_ms(max(timestamp)) - 3600000 FROM failures)""",
        "failures",
    )
)
def stream_quarantine_all(spark: SparkSession, folder: str) -> DataFrame:
    """All rules in a stream of three batches, those that compare a row with others included."""
    landing, out, checkpoint = (new_folder(spark, x) for x in ("landing", "checked", "progress"))
    bars, day = V.typed_bars(spark, folder), F.dayofmonth("timestamp")
    rules = {
        **Q.single_row_rules(),
        "derived": R.differs(F.col("points_change"), F.col("close") - F.col("_close")) | R.differs(F.col("change_in_oi"), F.col("open_interest") - F.col("_interest")),
        "duplicate": F.col(state.COPIES) > 1,
    }
    for turn in (day <= 9, day.between(10, 19), day > 19):
        bars.where(turn).write.mode("append").parquet(landing)
        stream = feed(_stream_session(spark), landing, bars.schema, "parquet")
        told = state.with_previous(stream, "symbol", "timestamp", ["source", "copy"], {"_close": "close", "_interest": "open_interest"}, ["instrument_type"])
        sinks.each_batch(told, sinks.quarantine_to(out, rules), checkpoint).awaitTermination()
    shape = "source string, mark bigint, copy int"
    valid = spark.read.schema(shape).parquet(f"{out}/valid").withColumn(C.REASONS, F.lit(""))
    bad = spark.read.schema(f"{shape}, {C.REASONS} array<string>").parquet(f"{out}/quarantine")
    both = valid.unionByName(bad.withColumn(C.REASONS, F.array_join(C.REASONS, ",")))
    return both.select("source", "mark", "copy", C.REASONS)


@query(
    sql(
        """
SELECT user_id, max(ts) AS ts, arg_max(trade_id, row(ts, trade_id)) AS trade_id,
       arg_max(price, row(ts, trade_id)) AS price
FROM ticks GROUP BY user_id""",
        "ticks",
    )
)
def stream_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The newest trade per user, from events that arrive in four batches out of order; Spark keeps it."""
    columns = ["user_id", "ts", "trade_id", "price"]
    turns = [F.col("event_id") % 4 == k for k in (2, 0, 3, 1)]
    how = ["user_id"], "ts", ["trade_id"]
    stream = lambda events: state.newest_rows(V.as_ticks(events).select(*columns), *how)
    _, checkpoint = _turned(spark, folder, turns, stream, "update", "latest")
    newest = state.read_newest(spark, checkpoint, *how, V.ticks(spark, folder).select(*columns).schema)
    return newest.withColumn("ts", plain(F.col("ts")))
