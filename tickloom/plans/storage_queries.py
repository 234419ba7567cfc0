"""Queries for tables, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.timing import plain
from tickloom.operators.market import latest
from tickloom.operators.normalize import normalize_equity, normalize_indices as normalize_index_rows
from tickloom.operators.validate import feed_rules, validate
from tickloom.plans import views as V
from tickloom.plans.registry import query
from tickloom.plans.views import sql
from tickloom.schemas import CORRUPT, EQUITY, RAW_EQUITY
from tickloom.sources import feeds, files, logs, tables
from tickloom.workspace import new_folder, subfolders

EXCHANGE_DATE = "CAST(bar + INTERVAL 330 MINUTE AS DATE)"


def _plain_times(df: DataFrame) -> DataFrame:
    times = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: plain(F.col(c)) for c in times})


def _roundtrip(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    base = new_folder(spark, name)
    tables.write_table(rows, base, name, V.LOADED)
    return _plain_times(tables.read_table(spark, base, name))


_EQUITY_SQL = f"""
SELECT symbol, 'EQ' AS series, {EXCHANGE_DATE} AS date, bar AS timestamp,
       open, high, low, close, close AS last, open AS prev_close,
       volume AS total_traded_quantity, CAST(value AS DECIMAL(18,2)) AS total_traded_value,
       trades AS total_trades, 'IN' || upper(symbol) AS isin,
       TIMESTAMP '{V.LOADED}' AS created_at
FROM hour_bars"""


@query(sql(_EQUITY_SQL, "hour_bars"))
def equity_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return _roundtrip(spark, V.equity_rows(spark, folder), "equity")


@query(
    sql(
        f"""
SELECT symbol, {EXCHANGE_DATE} + 30 AS expiry_date,
       CASE WHEN hour(bar) % 2 = 0 THEN 'OPTSTK' ELSE 'FUTSTK' END AS instrument_type,
       CAST(CASE WHEN hour(bar) % 2 = 0 THEN 100 END AS DECIMAL(18,4)) AS strike_price,
       CASE WHEN hour(bar) % 2 = 0 THEN 'CE' END AS option_type,
       {EXCHANGE_DATE} AS date, bar AS timestamp, open, high, low, close, close AS last,
       open AS prev_close, volume, CAST(value AS DECIMAL(18,2)) AS value,
       volume * 10 AS open_interest, volume - 50 AS change_in_oi,
       TIMESTAMP '{V.LOADED}' AS created_at
FROM hour_bars""",
        "hour_bars",
    )
)
def derivatives_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return _roundtrip(spark, V.derivative_rows(spark, folder), "derivatives")


@query(
    sql(
        f"""
SELECT upper(symbol) AS index_name, {EXCHANGE_DATE} AS date, bar AS timestamp,
       open, high, low, close, CAST(close - open AS DECIMAL(18,4)) AS points_change,
       CAST(trades AS DECIMAL(18,4)) AS percent_change, volume,
       CAST(value AS DECIMAL(18,2)) AS turnover, high AS pe, low AS pb,
       CAST(NULL AS DECIMAL(18,4)) AS div_yield, TIMESTAMP '{V.LOADED}' AS created_at
FROM hour_bars""",
        "hour_bars",
    )
)
def indices_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    return _roundtrip(spark, V.index_rows(spark, folder), "indices")


@query(
    sql(
        """
SELECT metric_name, metric_value, user_label, shard,
       date_trunc('milliseconds', timestamp) AS timestamp
FROM metric_rows""",
        "metric_rows",
    )
)
def metrics_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    stored = _roundtrip(spark, V.metric_rows(spark, folder), "system_metrics")
    return stored.select(
        "metric_name",
        "metric_value",
        F.col("labels")["user"].alias("user_label"),
        F.col("labels")["shard"].alias("shard"),
        "timestamp",
    )


@query(
    sql(
        """
SELECT log_level, component, message, user_label,
       date_trunc('milliseconds', timestamp) AS timestamp
FROM log_rows""",
        "log_rows",
    )
)
def logs_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    stored = _roundtrip(spark, V.log_rows(spark, folder), "processing_logs")
    user = F.col("extra")["user"].alias("user_label")
    return stored.select("log_level", "component", "message", user, "timestamp")


@query(
    sql(
        f"""
SELECT trade_id,
       CASE WHEN qty > 50 THEN CAST(ts + INTERVAL 330 MINUTE AS DATE)
            ELSE DATE '2024-02-01' END AS date,
       CASE WHEN qty > 20 THEN ts ELSE TIMESTAMP '{V.LOADED}' END AS created_at
FROM ticks""",
        "ticks",
    )
)
def defaults_applied(spark: SparkSession, folder: str) -> DataFrame:
    given = V.ticks(spark, folder).select(
        "trade_id",
        F.when(F.col("qty") > 50, tables.exchange_day(F.col("ts"))).alias("date"),
        F.when(F.col("qty") > 20, F.col("ts")).alias("created_at"),
    )
    return _plain_times(tables.apply_defaults(given, "equity", V.LOADED))


@query(
    sql(
        """
SELECT CAST(year(date) * 100 + month(date) AS INTEGER) AS month, count(*) AS n
FROM daily GROUP BY 1""",
        "daily",
    )
)
def rows_per_month(spark: SparkSession, folder: str) -> DataFrame:
    month = tables.month_column(EQUITY).alias(tables.MONTH)
    return V.daily(spark, folder).groupBy(month).agg(F.count(F.lit(1)).alias("n"))


@query(
    sql(
        """
SELECT symbol, bar AS timestamp, open, close, volume AS total_traded_quantity
FROM hour_bars
WHERE symbol = 'click' AND bar >= TIMESTAMP '2024-01-10 06:00:00'
  AND bar < TIMESTAMP '2024-01-20'""",
        "hour_bars",
    )
)
def key_range_scan(spark: SparkSession, folder: str) -> DataFrame:
    base = new_folder(spark, "equity")
    tables.write_table(V.equity_rows(spark, folder), base, "equity", V.LOADED)
    stored = tables.read_table(spark, base, "equity", "2024-01-10", "2024-01-20")
    found = tables.scan(stored, "equity", "click", "2024-01-10 06:00:00", "2024-01-20")
    return _plain_times(
        found.select("symbol", "timestamp", "open", "close", "total_traded_quantity")
    )


@query(
    sql(
        """
SELECT symbol, date, price, quantity FROM daily
WHERE CAST(date + INTERVAL 5 YEAR AS DATE) > DATE '2004-02-29'""",
        "daily",
    )
)
def retention_5y(spark: SparkSession, folder: str) -> DataFrame:
    kept = tables.retain(V.daily(spark, folder), "equity", "2004-02-29")
    return kept.select("symbol", "date", "price", "quantity")


@query(
    sql(
        """
SELECT metric_name, metric_value, timestamp FROM metric_rows
WHERE timestamp + INTERVAL 90 DAY > TIMESTAMP '2024-04-12 10:00:00'""",
        "metric_rows",
    )
)
def retention_90d(spark: SparkSession, folder: str) -> DataFrame:
    kept = tables.retain(V.metric_rows(spark, folder), "system_metrics", "2024-04-12 10:00:00")
    return _plain_times(kept.drop("labels"))


@query(
    sql(
        """
SELECT log_level, component, timestamp FROM log_rows
WHERE timestamp + INTERVAL 30 DAY > TIMESTAMP '2024-02-14 10:00:00'""",
        "log_rows",
    )
)
def retention_30d(spark: SparkSession, folder: str) -> DataFrame:
    kept = tables.retain(V.log_rows(spark, folder), "processing_logs", "2024-02-14 10:00:00")
    return _plain_times(kept.select("log_level", "component", "timestamp"))


@query(
    sql(
        """
SELECT symbol, date, price, quantity FROM daily
WHERE date + 365 > DATE '2001-02-28'""",
        "daily",
    )
)
def retention_365d(spark: SparkSession, folder: str) -> DataFrame:
    """The shorter retention some set-ups ask for."""
    kept = tables.retain(V.daily(spark, folder), "equity", "2001-02-28", override_days=365)
    return kept.select("symbol", "date", "price", "quantity")


@query(
    sql(
        """
SELECT upper(symbol) AS index_name, bar AS timestamp, CAST(2 AS BIGINT) AS n
FROM hour_bars""",
        "hour_bars",
    )
)
def append_keeps_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    base = new_folder(spark, "indices")
    for _ in range(2):
        tables.write_table(V.index_rows(spark, folder), base, "indices", V.LOADED)
    stored = tables.read_table(spark, base, "indices")
    return _plain_times(
        stored.groupBy("index_name", "timestamp").agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    sql(
        _EQUITY_SQL.replace("'IN' || upper(symbol) AS isin", "CAST(NULL AS VARCHAR) AS isin"),
        "hour_bars",
    )
)
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    landing, base, state = (new_folder(spark, n) for n in ("landing", "equity", "progress"))
    _land(V.raw_equity(spark, folder), landing)
    _take_in(spark, landing, base, "equity", state, files_per_batch=2)
    return _plain_times(tables.read_table(spark, base, "equity"))


def _land(rows: DataFrame, landing: str) -> None:
    """Records as JSON files, in several writes."""
    for part in (0, 1, 2):
        turn = F.pmod(F.xxhash64("timestamp"), F.lit(3)) == part
        rows.filter(turn).write.mode("append").json(landing)


def _take_in(spark: SparkSession, landing: str, base: str, table: str, state: str, **bounds: int) -> None:
    how = {"cadenced": False, **bounds}
    feeds.ingest_feed(spark, landing, base, table, state, V.LOADED, **how).awaitTermination()


@query(
    sql(
        f"""
SELECT symbol, {EXCHANGE_DATE} + 30 - CASE WHEN CAST(bar AS DATE) < {EXCHANGE_DATE} THEN 1 ELSE 0 END AS expiry_date,
       'FUTIDX' AS instrument_type, CAST(0 AS DECIMAL(18,4)) AS strike_price, '' AS option_type,
       {EXCHANGE_DATE} AS date, bar AS timestamp, open, high, low, close, close AS last, open AS prev_close,
       volume, CAST(value AS DECIMAL(18,2)) AS value, volume * 10 AS open_interest, volume - 50 AS change_in_oi,
       TIMESTAMP '{V.LOADED}' AS created_at
FROM hour_bars""",
        "hour_bars",
    )
)
def stream_ingest_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    landing, base, state = (new_folder(spark, n) for n in ("landing", "derivatives", "progress"))
    _land(V.raw_derivatives(spark, folder), landing)
    _take_in(spark, landing, base, "derivatives", state)
    return _plain_times(tables.read_table(spark, base, "derivatives"))


_INDEX_SQL = f"""
SELECT upper(symbol) AS index_name, {EXCHANGE_DATE} AS date, bar AS timestamp,
       open, high, low, close, CAST(close - open AS DECIMAL(18,4)) AS points_change,
       CAST(trades AS DECIMAL(18,4)) AS percent_change, volume,
       CAST(value AS DECIMAL(18,2)) AS turnover, high AS pe, low AS pb,
       CAST(NULL AS DECIMAL(18,4)) AS div_yield"""


@query(sql(f"{_INDEX_SQL}, TIMESTAMP '{V.LOADED}' AS created_at FROM hour_bars", "hour_bars"))
def stream_ingest_indices(spark: SparkSession, folder: str) -> DataFrame:
    landing, base, state = (new_folder(spark, n) for n in ("landing", "indices", "progress"))
    _land(V.raw_indices(spark, folder), landing)
    _take_in(spark, landing, base, "indices", state)
    return _plain_times(tables.read_table(spark, base, "indices"))


@query(sql(f"{_INDEX_SQL}, '' AS type_errors FROM hour_bars", "hour_bars"))
def normalize_indices(spark: SparkSession, folder: str) -> DataFrame:
    done = normalize_index_rows(V.raw_indices(spark, folder))
    return _plain_times(done.withColumn("type_errors", F.array_join("type_errors", ",")))


@query(
    sql(
        """
SELECT symbol, count(*) * 3 AS rows, CAST(sum(volume) * 3 AS BIGINT) AS volume FROM hour_bars GROUP BY symbol""",
        "hour_bars",
    )
)
def ingest_then_append(spark: SparkSession, folder: str) -> DataFrame:
    """A table that holds a stream's rows and those of two batch writes, with its months compacted."""
    landing, base, state = (new_folder(spark, n) for n in ("landing", "equity", "progress"))
    _land(V.raw_equity(spark, folder), landing)
    tables.write_table(V.equity_rows(spark, folder), base, "equity", V.LOADED)
    _take_in(spark, landing, base, "equity", state)
    tables.write_table(V.equity_rows(spark, folder), base, "equity", V.LOADED)
    for name in subfolders(spark, tables.table_path(base, "equity")):
        tables.compact_month(spark, base, "equity", int(name.split("=")[1]))
    found = tables.read_table(spark, base, "equity").groupBy("symbol")
    return found.agg(F.count(F.lit(1)).alias("rows"), F.sum("total_traded_quantity").alias("volume"))


@query(
    sql(
        f"""
WITH dated AS (SELECT symbol, {EXCHANGE_DATE} AS date, volume FROM hour_bars)
SELECT symbol, count(*) AS rows, CAST(sum(volume) AS BIGINT) AS volume FROM dated
WHERE date + INTERVAL 365 DAY > DATE '2025-01-15' GROUP BY symbol""",
        "hour_bars",
    )
)
def retention_on_table(spark: SparkSession, folder: str) -> DataFrame:
    """A streamed table read on after its expired months are deleted and more rows came in."""
    landing, base, state = (new_folder(spark, n) for n in ("landing", "equity", "progress"))
    rows, early = V.raw_equity(spark, folder), F.pmod(F.xxhash64("symbol"), F.lit(2)) == 0
    rows.filter(early).write.json(landing)
    _take_in(spark, landing, base, "equity", state)
    tables.expire_months(spark, base, "equity", "2025-01-15", override_days=365)
    rows.filter(~early).write.mode("append").json(landing)
    _take_in(spark, landing, base, "equity", state)
    kept = tables.read_kept(spark, base, "equity", "2025-01-15", override_days=365).groupBy("symbol")
    return kept.agg(F.count(F.lit(1)).alias("rows"), F.sum("total_traded_quantity").alias("volume"))


@query(
    sql(
        """
SELECT trade_id, trade_id % 10 <> 7 AS readable,
       CASE WHEN trade_id % 10 IN (3, 7) THEN 'required,unreadable' WHEN price < 0 THEN 'range' ELSE '' END AS reasons,
       CASE WHEN trade_id % 10 = 3 THEN 'open' WHEN trade_id % 10 = 7 THEN '_corrupt' ELSE '' END AS unread
FROM ticks""",
        "ticks",
    )
)
def feed_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Records from JSON files: some have a word for a price, others break off."""
    landing = new_folder(spark, "landing")
    p, k = F.col("price").cast("string"), F.col("trade_id")
    opened = F.when(k % 10 == 3, F.lit('"abc"')).otherwise(p)
    line = F.concat(
        F.lit('{"symbol": "S'), k.cast("string"), F.lit('", "series": "EQ", "open": '), opened,
        *[x for c in ("high", "low", "close", "last", "prevClose") for x in (F.lit(f', "{c}": '), p)],
        F.lit(', "tottrdqty": 0, "tottrdval": 0, "timestamp": "2024-01-02T10:00:00+05:30", "totaltrades": 1}'),
    )
    broken = F.concat(F.lit('{"series": "EQ", "symbol": "S'), k.cast("string"))
    V.ticks(spark, folder).select(F.when(k % 10 == 7, broken).otherwise(line).alias("value")).write.text(landing)
    records = files.bulk_load(spark, landing, "json", RAW_EQUITY)
    rows = validate(normalize_equity(records), feed_rules("equity"))
    number = F.coalesce(F.col("symbol"), F.regexp_extract(CORRUPT, '"(S[0-9]+)$', 1))
    return rows.select(
        F.substring(number, 2, 20).cast("bigint").alias("trade_id"), F.col(CORRUPT).isNull().alias("readable"),
        F.array_join("reasons", ",").alias("reasons"), F.array_join("type_errors", ",").alias("unread"),
    )


@query(
    sql(
        """
SELECT symbol, qty = 0 AS is_corrupt, count(*) AS n,
       CAST(CASE WHEN qty = 0 THEN NULL ELSE sum(price) END AS DECIMAL(28,4)) AS price_sum
FROM (SELECT CASE WHEN qty = 0 THEN NULL ELSE symbol END AS symbol,
             CASE WHEN qty = 0 THEN 0 ELSE 1 END AS qty, price FROM ticks)
GROUP BY symbol, qty""",
        "ticks",
    )
)
def bulk_load_counts(spark: SparkSession, folder: str) -> DataFrame:
    """CSV lines; those of trades without quantity have no readable price."""
    path = new_folder(spark, "csv")
    price = F.when(F.col("qty") == 0, "none").otherwise(F.col("price").cast("string"))
    lines = V.ticks(spark, folder).select(
        F.concat_ws(",", "symbol", price, F.col("qty").cast("string")).alias("value")
    )
    lines.write.text(path)
    schema = spark.createDataFrame([], "symbol string, price decimal(18,4), qty bigint").schema
    rows = files.bulk_load(spark, path, "csv", schema)
    corrupt = F.col(files.CORRUPT).isNotNull()
    return (
        rows.select(
            F.when(~corrupt, F.col("symbol")).alias("symbol"),
            corrupt.alias("is_corrupt"),
            F.when(~corrupt, F.col("price")).alias("price"),
        )
        .groupBy("symbol", "is_corrupt")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("price_sum"))
    )


@query(
    sql(
        """
SELECT TIMESTAMP '2024-01-01 18:00:00' AS snapshot, symbol, count(*) AS n
FROM ticks GROUP BY symbol
UNION ALL
SELECT TIMESTAMP '2024-01-31 12:00:00', symbol, count(*) FROM ticks GROUP BY symbol""",
        "ticks",
    )
)
def snapshot_expiry(spark: SparkSession, folder: str) -> DataFrame:
    """Of three snapshots the one that is exactly 30 days old is gone."""
    path = new_folder(spark, "snapshots")
    rows = V.ticks(spark, folder)
    now = "2024-01-31 12:00:00"
    for moment in ("2024-01-01 12:00:00", "2024-01-01 18:00:00", now):
        files.write_snapshot(rows, path, moment)
    files.expire_snapshots(spark, path, now)
    kept = files.read_snapshots(spark, path, rows.schema, now)
    counts = kept.groupBy("snapshot", "symbol").agg(F.count(F.lit(1)).alias("n"))
    return _plain_times(counts)


@query(
    sql(
        """
SELECT symbol, max(ts) AS ts, arg_max(trade_id, row(ts, trade_id)) AS trade_id,
       arg_max(price, row(ts, trade_id)) AS price, arg_max(qty, row(ts, trade_id)) AS qty
FROM ticks GROUP BY symbol""",
        "ticks",
    )
)
def latest_per_symbol(spark: SparkSession, folder: str) -> DataFrame:
    newest = latest(V.ticks(spark, folder).drop("user_id"), ["symbol"], "ts", ["trade_id"])
    return _plain_times(newest)


_JSON_SQL = """
WITH lines AS (
  SELECT doc_id, '{"timestamp": "2024-01-01 00:00:00.' || lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0')
    || '", "level": "INFO", "service": "loader", "version": "0.1.0", '
    || '"environment": "production", "module": "' || source
    || '", "function": "load", "line": ' || n_chars || ', "message": "' || text || '"}' AS line
  FROM documents),
parsed AS (SELECT *, CASE WHEN json_valid(line) THEN line END AS good FROM lines)
SELECT doc_id, good ->> '$.level' AS log_level, good ->> '$.module' AS component,
       good ->> '$.message' AS message, good ->> '$.line' AS line,
       CAST(good ->> '$.timestamp' AS TIMESTAMP) AS timestamp,
       CASE WHEN good IS NULL THEN line END AS corrupt
FROM parsed"""


@query(_JSON_SQL)
def json_log_parse(spark: SparkSession, folder: str) -> DataFrame:
    rows = logs.parse_json_logs(V.json_lines(spark, folder), "line", "doc_id")
    return rows.select(
        "doc_id",
        "log_level",
        "component",
        "message",
        F.col("extra")["line"].alias("line"),
        plain(F.col("timestamp")).alias("timestamp"),
        F.col(logs.CORRUPT).alias("corrupt"),
    )


@query(
    r"""
WITH lines AS (
  SELECT doc_id, lang, source, n_chars, text,
         '2024-01-01 00:00:00.' || lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0') AS clock,
         rpad(CASE WHEN lang = 'en' THEN 'INFO' ELSE 'WARNING' END, 8, ' ') AS level
  FROM documents)
SELECT doc_id,
       CASE WHEN lang <> 'de' THEN trim(level) END AS log_level,
       CASE WHEN lang <> 'de' THEN source END AS component,
       CASE WHEN lang <> 'de' THEN text || ' | end' END AS message,
       CASE WHEN lang <> 'de' THEN CAST(n_chars AS VARCHAR) END AS line,
       CASE WHEN lang <> 'de' THEN CAST(clock AS TIMESTAMP) END AS timestamp,
       CASE WHEN lang = 'de' THEN clock || ' | ' || level || ' | loader | ' || n_chars || ' | '
            || text || ' | end' END AS corrupt
FROM lines"""
)
def text_log_parse(spark: SparkSession, folder: str) -> DataFrame:
    rows = logs.parse_text_logs(V.text_lines(spark, folder), "line", "doc_id")
    return rows.select(
        "doc_id",
        "log_level",
        "component",
        "message",
        F.col("extra")["line"].alias("line"),
        plain(F.col("timestamp")).alias("timestamp"),
        F.col(logs.CORRUPT).alias("corrupt"),
    )
