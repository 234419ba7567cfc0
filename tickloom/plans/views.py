"""Market-like views over the test tables, in Spark and, for the checks, in SQL.

The test tables hold no market data. Ticks come from `events`, trades by day from `lineitem` and
`part`, log lines from `documents`. All views cover whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.timing import exchange_day
from tickloom.operators.indicators import price_change
from tickloom.operators.market import bars, expected_instruments

LOADED = "2024-02-01 00:00:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    return as_ticks(table(spark, folder, "events"))


def as_ticks(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").cast("decimal(18,4)").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("qty"),
        F.col("event_id").alias("trade_id"),
        "user_id",
    )


def hour_bars(spark: SparkSession, folder: str) -> DataFrame:
    return bars(ticks(spark, folder), "1 hour")


def daily(spark: SparkSession, folder: str) -> DataFrame:
    """Trades by day: a brand is the symbol, the order line tells trades of a day apart."""
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    lines = table(spark, folder, "lineitem")
    return lines.join(parts, lines.l_partkey == parts.p_partkey).select(
        F.col("p_brand").alias("symbol"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_extendedprice").cast("decimal(18,4)").alias("price"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
    )


def batches(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")

    def per(kind: str, key: str) -> DataFrame:
        good = F.count_if(F.col("l_discount") < 0.10)
        return lines.groupBy(key).agg(
            F.concat(F.lit(f"{kind}-"), F.col(key).cast("string")).alias("operation"),
            F.count(F.lit(1)).alias("records_processed"),
            F.sum(F.col("l_tax").cast("decimal(18,4)")).cast("double").alias("processing_time"),
            (good / F.count(F.lit(1))).alias("success_rate"),
        ).drop(key)

    return per("order", "l_orderkey").unionByName(per("supplier", "l_suppkey"))


def requests(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.when(kind == "purchase", "POST").otherwise("GET").alias("method"),
        F.concat(F.lit("/api/"), kind).alias("path"),
        F.when(kind == "error", 500).when(kind == "signup", 404).otherwise(200).alias("status_code"),
        (F.col("value") * 10).alias("response_time"),
        F.concat(F.lit("req-"), F.col("event_id").cast("string")).alias("request_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        "props",
    )


def level_of(kind: Column) -> Column:
    return (
        F.when(kind == "error", "ERROR")
        .when(kind == "signup", "WARNING")
        .when(kind == "view", "DEBUG")
        .when(kind == "purchase", "critical")
        .otherwise("INFO")
    )


def metric_rows(spark: SparkSession, folder: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    return table(spark, folder, "events").select(
        F.concat(F.lit("value_"), F.col("event_type")).alias("metric_name"),
        F.col("value").alias("metric_value"),
        F.create_map(
            F.lit("user"), user, F.lit("shard"), F.substring(user, -1, 1)
        ).alias("labels"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def log_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        level_of(F.col("event_type")).alias("log_level"),
        F.col("event_type").alias("component"),
        F.col("props").alias("message"),
        F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("extra"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def equity_rows(spark: SparkSession, folder: str) -> DataFrame:
    return hour_bars(spark, folder).select(
        "symbol",
        F.lit("EQ").alias("series"),
        exchange_day(F.col("bar")).alias("date"),
        F.col("bar").alias("timestamp"),
        *["open", "high", "low", "close"],
        F.col("close").alias("last"),
        F.col("open").alias("prev_close"),
        F.col("volume").alias("total_traded_quantity"),
        F.col("value").alias("total_traded_value"),
        F.col("trades").alias("total_trades"),
        F.concat(F.lit("IN"), F.upper("symbol")).alias("isin"),
    )


def derivative_rows(spark: SparkSession, folder: str) -> DataFrame:
    option = F.hour("bar") % 2 == 0
    return hour_bars(spark, folder).select(
        "symbol",
        F.date_add(exchange_day(F.col("bar")), 30).alias("expiry_date"),
        F.when(option, "OPTSTK").otherwise("FUTSTK").alias("instrument_type"),
        F.when(option, F.lit(100)).cast("decimal(18,4)").alias("strike_price"),
        F.when(option, "CE").alias("option_type"),
        exchange_day(F.col("bar")).alias("date"),
        F.col("bar").alias("timestamp"),
        *["open", "high", "low", "close"],
        F.col("close").alias("last"),
        F.col("open").alias("prev_close"),
        "volume",
        "value",
        (F.col("volume") * 10).alias("open_interest"),
        (F.col("volume") - 50).alias("change_in_oi"),
    )


def index_rows(spark: SparkSession, folder: str) -> DataFrame:
    return hour_bars(spark, folder).select(
        F.upper("symbol").alias("index_name"),
        exchange_day(F.col("bar")).alias("date"),
        F.col("bar").alias("timestamp"),
        *["open", "high", "low", "close"],
        (F.col("close") - F.col("open")).alias("points_change"),
        F.col("trades").alias("percent_change"),
        "volume",
        F.col("value").alias("turnover"),
        F.col("high").alias("pe"),
        F.col("low").alias("pb"),
    )


def raw_equity(spark: SparkSession, folder: str) -> DataFrame:
    """Hour bars as the equity feed would send them."""
    local = F.col("bar") + F.expr("INTERVAL '05:30' HOUR TO MINUTE")
    return hour_bars(spark, folder).select(
        "symbol",
        F.lit("EQ").alias("series"),
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")],
        F.col("close").cast("double").alias("last"),
        F.col("open").cast("double").alias("prevClose"),
        F.col("volume").alias("tottrdqty"),
        F.col("value").cast("double").alias("tottrdval"),
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss'+05:30'").alias("timestamp"),
        F.col("trades").alias("totaltrades"),
    )


def raw_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    local = F.col("bar") + F.expr("INTERVAL '05:30' HOUR TO MINUTE")
    return hour_bars(spark, folder).select(
        "symbol",
        F.date_format(F.date_add(F.to_date("bar"), 30), "yyyy-MM-dd").alias("expiryDate"),
        F.lit("FUTIDX").alias("instrumentType"),
        F.lit(0.0).alias("strikePrice"),
        F.lit("").alias("optionType"),
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")],
        F.col("close").cast("double").alias("last"),
        F.col("open").cast("double").alias("prevClose"),
        "volume",
        F.col("value").cast("double").alias("value"),
        (F.col("volume") * 10).alias("openInterest"),
        (F.col("volume") - 50).alias("changeInOI"),
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss'+05:30'").alias("timestamp"),
    )


def raw_indices(spark: SparkSession, folder: str) -> DataFrame:
    """Hour bars as an index feed would send them."""
    local = F.col("bar") + F.expr("INTERVAL '05:30' HOUR TO MINUTE")
    return hour_bars(spark, folder).select(
        F.upper("symbol").alias("indexName"),
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")],
        (F.col("close") - F.col("open")).alias("pointsChange"),
        F.col("trades").alias("percentChange"),
        "volume",
        F.col("value").cast("decimal(28,4)").alias("turnover"),
        F.col("high").alias("pe"),
        F.col("low").alias("pb"),
        F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss'+05:30'").alias("timestamp"),
    )


def json_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Log lines whose message is a document, pasted in unescaped."""
    return table(spark, folder, "documents").select(
        "doc_id",
        F.concat(
            F.lit('{"timestamp": "2024-01-01 00:00:00.'),
            F.lpad((F.col("doc_id") % 1000).cast("string"), 3, "0"),
            F.lit('", "level": "INFO", "service": "loader", "version": "0.1.0", '),
            F.lit('"environment": "production", "module": "'),
            F.col("source"),
            F.lit('", "function": "load", "line": '),
            F.col("n_chars").cast("string"),
            F.lit(', "message": "'),
            F.col("text"),
            F.lit('"}'),
        ).alias("line"),
    )


def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Coloured text log lines whose message is a document; without a source there is no location."""
    esc = "\u001b"
    return table(spark, folder, "documents").select(
        "doc_id",
        F.concat(
            F.lit(f"{esc}[32m2024-01-01 00:00:00."),
            F.lpad((F.col("doc_id") % 1000).cast("string"), 3, "0"),
            F.lit(f"{esc}[0m | {esc}[1m"),
            F.rpad(F.when(F.col("lang") == "en", "INFO").otherwise("WARNING"), 8, " "),
            F.lit(f"{esc}[0m | loader | "),
            F.when(F.col("lang") == "de", F.lit("")).otherwise(F.concat("source", F.lit(":load:"))),
            F.col("n_chars").cast("string"),
            F.lit(" | "),
            F.col("text"),
            F.lit(" | end"),
        ).alias("line"),
    )


def dirty_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Hour bars as raw text with faults put in; `mark` decides which row has which fault."""
    hourly = hour_bars(spark, folder).withColumn(
        "mark", F.floor(F.unix_timestamp("bar") / 3600) + F.length("symbol")
    )
    # One bar per symbol and hour: too few to be cut.
    with_prices = price_change(hourly, "symbol", "bar", "close", None).withColumnRenamed(
        "change", "points"
    )
    rows = price_change(
        with_prices.drop("prev_price", "change_pct"), "symbol", "bar", "volume", None
    ).withColumnRenamed("change", "interest")

    def every(n: int) -> Column:
        return F.col("mark") % n == 0

    def text(c: Column) -> Column:
        return c.cast("string")

    option = every(2)
    low, high = F.col("low"), F.col("high")
    zero, hundred = F.lit("0"), F.lit("100")
    faulty = rows.select(
        F.col("symbol").alias("source"),
        "mark",
        F.when(every(89), "  ").otherwise(F.col("symbol")).alias("symbol"),
        F.col("bar").alias("timestamp"),
        text(F.when(every(97), -F.col("open")).otherwise(F.col("open"))).alias("raw_open"),
        text(F.when(every(79), low).otherwise(high)).alias("raw_high"),
        text(F.when(every(79), high).otherwise(low)).alias("raw_low"),
        F.when(every(83), "abc").otherwise(text(F.col("close"))).alias("raw_close"),
        F.col("volume"),
        F.when(every(73), F.col("value") * 20 + 1)
        .otherwise(F.col("value"))
        .cast("decimal(18,2)")
        .alias("value"),
        F.when(option, "OPTSTK").otherwise("FUTSTK").alias("instrument_type"),
        F.when(every(67), F.when(option, zero).otherwise(hundred))
        .otherwise(F.when(option, hundred).otherwise(zero))
        .cast("decimal(18,4)")
        .alias("strike_price"),
        F.when(option, "CE").otherwise("").alias("option_type"),
        (F.coalesce("points", F.lit(0)) + F.when(every(61), 1).otherwise(0))
        .cast("decimal(18,4)")
        .alias("points_change"),
        (F.col("volume") + 1000).alias("open_interest"),
        (F.coalesce("interest", F.lit(0)) + F.when(every(59), 5).otherwise(0)).alias("change_in_oi"),
    )
    copies = F.explode(F.when(every(71), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return faulty.withColumn("copy", copies)


def typed_bars(spark: SparkSession, folder: str) -> DataFrame:
    return dirty_bars(spark, folder).withColumns(
        {
            c: F.col(f"raw_{c}").try_cast("decimal(18,4)")
            for c in ("open", "high", "low", "close")
        }
    )


def seen_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("instrument"),
        F.to_date(F.trunc("l_shipdate", "month")).alias("date"),
    )


def listed_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """Every part is expected in each month from its first to its last order line."""
    seen = seen_by_month(spark, folder).groupBy("instrument")
    return seen.agg(F.min("date").alias("first"), F.max("date").alias("last"))


def expected_by_month(spark: SparkSession, folder: str, since: str | None = None, until: str | None = None) -> DataFrame:
    listed = listed_by_month(spark, folder)
    return expected_instruments(listed, "instrument", "first", "last", "INTERVAL 1 MONTH", since, until)


# The same views in SQL, for checks only. A view may use those before it.
SQL_VIEWS = {
    "ticks": """
        SELECT event_type AS symbol, ts, CAST(value AS DECIMAL(18,4)) AS price,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS qty,
               event_id AS trade_id, user_id
        FROM events""",
    "hour_bars": """
        SELECT symbol, date_trunc('hour', ts) AS bar,
               arg_min(price, row(ts, trade_id)) AS open, max(price) AS high,
               min(price) AS low, arg_max(price, row(ts, trade_id)) AS close,
               CAST(sum(qty) AS BIGINT) AS volume, sum(price * qty) AS value,
               count(*) AS trades
        FROM ticks GROUP BY ALL""",
    "daily": """
        SELECT p_brand AS symbol, CAST(l_shipdate AS DATE) AS date,
               CAST(l_extendedprice AS DECIMAL(18,4)) AS price,
               CAST(l_quantity AS BIGINT) AS quantity,
               l_orderkey, l_linenumber, l_partkey, l_suppkey
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "batches": """
        SELECT 'order-' || l_orderkey AS operation, count(*) AS records_processed,
               CAST(sum(CAST(l_tax AS DECIMAL(18,4))) AS DOUBLE) AS processing_time,
               count(*) FILTER (l_discount < 0.10) / count(*) AS success_rate
        FROM lineitem GROUP BY l_orderkey
        UNION ALL
        SELECT 'supplier-' || l_suppkey, count(*),
               CAST(sum(CAST(l_tax AS DECIMAL(18,4))) AS DOUBLE),
               count(*) FILTER (l_discount < 0.10) / count(*)
        FROM lineitem GROUP BY l_suppkey""",
    "requests": """
        SELECT CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method,
               '/api/' || event_type AS path,
               CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 404 ELSE 200 END
                 AS status_code,
               value * 10 AS response_time, 'req-' || event_id AS request_id,
               ts AS timestamp, props
        FROM events""",
    "metric_rows": """
        SELECT 'value_' || event_type AS metric_name, value AS metric_value,
               CAST(user_id AS VARCHAR) AS user_label,
               right(CAST(user_id AS VARCHAR), 1) AS shard, ts AS timestamp
        FROM events""",
    "log_rows": """
        SELECT CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING'
                    WHEN 'view' THEN 'DEBUG' WHEN 'purchase' THEN 'critical' ELSE 'INFO' END
                 AS log_level,
               event_type AS component, props AS message,
               CAST(user_id AS VARCHAR) AS user_label, ts AS timestamp
        FROM events""",
    "marked_bars": """
        SELECT *, CAST(floor(epoch(bar) / 3600) AS BIGINT) + length(symbol) AS mark,
               coalesce(close - lag(close) OVER w, 0) AS points,
               coalesce(volume - lag(volume) OVER w, 0) AS interest
        FROM hour_bars WINDOW w AS (PARTITION BY symbol ORDER BY bar)""",
    "dirty_bars": """
        SELECT symbol AS source, mark,
               CASE WHEN mark % 89 = 0 THEN '  ' ELSE symbol END AS symbol, bar AS timestamp,
               CASE WHEN mark % 97 = 0 THEN -open ELSE open END AS open,
               CASE WHEN mark % 79 = 0 THEN low ELSE high END AS high,
               CASE WHEN mark % 79 = 0 THEN high ELSE low END AS low,
               CASE WHEN mark % 83 = 0 THEN NULL ELSE close END AS close,
               CASE WHEN mark % 83 = 0 THEN 'abc' ELSE CAST(close AS VARCHAR) END AS raw_close,
               volume,
               CAST(CASE WHEN mark % 73 = 0 THEN value * 20 + 1 ELSE value END
                    AS DECIMAL(18,2)) AS value,
               CASE WHEN mark % 2 = 0 THEN 'OPTSTK' ELSE 'FUTSTK' END AS instrument_type,
               CAST(CASE WHEN (mark % 67 = 0) = (mark % 2 = 0) THEN 0 ELSE 100 END
                    AS DECIMAL(18,4)) AS strike_price,
               CASE WHEN mark % 2 = 0 THEN 'CE' ELSE '' END AS option_type,
               CAST(points + CASE WHEN mark % 61 = 0 THEN 1 ELSE 0 END
                    AS DECIMAL(18,4)) AS points_change,
               volume + 1000 AS open_interest,
               CAST(interest + CASE WHEN mark % 59 = 0 THEN 5 ELSE 0 END AS BIGINT)
                 AS change_in_oi,
               unnest(CASE WHEN mark % 71 = 0 THEN [0, 1] ELSE [0] END) AS copy
        FROM marked_bars""",
    "checked_bars": """
        SELECT *, count(*) OVER (PARTITION BY symbol, instrument_type, timestamp) AS copies,
               lag(close) OVER w AS prev_close, lag(open_interest) OVER w AS prev_interest
        FROM dirty_bars
        WINDOW w AS (PARTITION BY symbol ORDER BY timestamp, source, copy)""",
    "failures": """
        SELECT *,
               trim(symbol) = '' AS f_required,
               close IS NULL AS f_type,
               coalesce(open < 0 OR high < 0 OR low < 0 OR close < 0 OR volume < 0, false)
                 AS f_range,
               coalesce(open < low, false) OR coalesce(open > high, false)
                 OR coalesce(close < low, false) OR coalesce(close > high, false) OR low > high
                 AS f_price_bounds,
               CASE WHEN volume > 0 THEN value < low * volume OR value > high * volume
                    ELSE value <> 0 END AS f_value,
               CASE WHEN instrument_type LIKE 'FUT%' THEN strike_price <> 0 OR option_type <> ''
                    ELSE NOT (strike_price > 0 AND option_type <> '') END AS f_leg,
               coalesce(abs(points_change - (close - prev_close)) > 0.01, false)
                 OR coalesce(abs(change_in_oi - (open_interest - prev_interest)) > 0.01, false)
                 AS f_derived,
               copies > 1 AS f_duplicate
        FROM checked_bars""",
    "seen_by_month": """
        SELECT l_partkey AS instrument, CAST(date_trunc('month', l_shipdate) AS DATE) AS date
        FROM lineitem""",
    "expected_by_month": """
        SELECT instrument, CAST(unnest(generate_series(
                 CAST(min(date) AS TIMESTAMP), CAST(max(date) AS TIMESTAMP), INTERVAL 1 MONTH))
               AS DATE) AS date
        FROM seen_by_month GROUP BY instrument""",
}

_USES = {
    "hour_bars": ["ticks"],
    "marked_bars": ["hour_bars"],
    "dirty_bars": ["marked_bars"],
    "checked_bars": ["dirty_bars"],
    "failures": ["checked_bars"],
    "expected_by_month": ["seen_by_month"],
}


def sql(body: str, *names: str, recursive: bool = False) -> str:
    """A statement over the named views."""
    wanted: set[str] = set()
    todo = list(names)
    while todo:
        name = todo.pop()
        wanted.add(name)
        todo += _USES.get(name, [])
    ctes = [f"{n} AS ({SQL_VIEWS[n]})" for n in SQL_VIEWS if n in wanted]
    if not ctes:
        return body
    start = "WITH RECURSIVE " if recursive else "WITH "
    rest = body.strip()
    if rest.upper().startswith("WITH "):
        return start + ",\n".join(ctes) + ",\n" + rest[5:]
    return start + ",\n".join(ctes) + "\n" + rest
