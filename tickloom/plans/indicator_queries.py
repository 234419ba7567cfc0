"""Queries for technical indicators; those ending in _hot cut every symbol into chunks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.timing import exchange_day, plain
from tickloom.operators import indicators as I
from tickloom.operators.ordered import Profile, profile
from tickloom.plans import views as V
from tickloom.plans.registry import query
from tickloom.plans.views import sql

TICK_ORDER = ["ts", "trade_id"]
TICK_WINDOW = "WINDOW w AS (PARTITION BY symbol ORDER BY ts, trade_id)"
BAR_WINDOW = "WINDOW w AS (PARTITION BY symbol ORDER BY bar)"
HOT_CHUNKS = 40
"""Chunks of a table, about: every symbol of every test table is cut, and larger tables are not cut finer."""
HOT_BARS = 40
HOT_DAY = 4


def _hot(spark: SparkSession, folder: str) -> Profile:
    ticks = V.ticks(spark, folder)
    return profile(ticks, "symbol", TICK_ORDER, max(25, ticks.count() // HOT_CHUNKS))


def _on_ticks(
    spark: SparkSession, folder: str, indicator: Callable[..., DataFrame], *outputs: str, **how
) -> DataFrame:
    done = indicator(V.ticks(spark, folder), "symbol", TICK_ORDER, **how)
    return done.select("trade_id", "symbol", *[_digits(done, c) for c in outputs])


def _on_bars(
    spark: SparkSession, folder: str, indicator: Callable[..., DataFrame], *outputs: str, **how
) -> DataFrame:
    done = indicator(V.hour_bars(spark, folder), "symbol", "bar", **how)
    return done.select(
        "symbol", plain(F.col("bar")).alias("bar"), *[_digits(done, c) for c in outputs]
    )


def _digits(df: DataFrame, column: str):
    """Doubles are compared to six digits."""
    if df.schema[column].dataType.typeName() == "double":
        return F.round(column, 6).alias(column)
    return F.col(column)


_CHANGE_SQL = sql(
    f"""
SELECT trade_id, symbol, lag(price) OVER w AS prev_price,
       CAST(price - lag(price) OVER w AS DECIMAL(19,4)) AS change,
       round(CAST(price - lag(price) OVER w AS DOUBLE) * 100
             / nullif(CAST(lag(price) OVER w AS DOUBLE), 0), 6) AS change_pct
FROM ticks {TICK_WINDOW}""",
    "ticks",
)


@query(_CHANGE_SQL)
def price_change(spark: SparkSession, folder: str) -> DataFrame:
    return _on_ticks(spark, folder, I.price_change, "prev_price", "change", "change_pct")


_RETURNS_SQL = sql(
    f"""
SELECT trade_id, symbol,
       round((p - lag(p) OVER w) / nullif(lag(p) OVER w, 0), 6) AS simple_return,
       round(ln(nullif(p, 0) / nullif(lag(p) OVER w, 0)), 6) AS log_return,
       round((p - lag(p, 10) OVER w) * 100 / nullif(lag(p, 10) OVER w, 0), 6) AS rate_of_change
FROM (SELECT *, CAST(price AS DOUBLE) AS p FROM ticks) {TICK_WINDOW}""",
    "ticks",
)


@query(_RETURNS_SQL)
def returns(spark: SparkSession, folder: str) -> DataFrame:
    return _on_ticks(
        spark, folder, I.returns, "simple_return", "log_return", "rate_of_change"
    )


_SMA_SQL = sql(
    f"""
SELECT trade_id, symbol,
       CASE WHEN count(*) OVER f = 20 THEN round(CAST(sum(price) OVER f AS DOUBLE) / 20, 6) END
         AS sma
FROM ticks
WINDOW f AS (PARTITION BY symbol ORDER BY ts, trade_id ROWS 19 PRECEDING)""",
    "ticks",
)


@query(_SMA_SQL)
def sma(spark: SparkSession, folder: str) -> DataFrame:
    return _on_ticks(spark, folder, I.sma, "sma")


@query(_SMA_SQL)
def sma_hot(spark: SparkSession, folder: str) -> DataFrame:
    return _on_ticks(spark, folder, I.sma, "sma", rows_per_task=_hot(spark, folder))


@query(
    sql(
        """
WITH stats AS (
  SELECT trade_id, symbol, count(*) OVER f AS n,
         CAST(sum(price) OVER f AS DOUBLE) / 20 AS middle,
         stddev_pop(CAST(price AS DOUBLE)) OVER f AS spread
  FROM ticks
  WINDOW f AS (PARTITION BY symbol ORDER BY ts, trade_id ROWS 19 PRECEDING))
SELECT trade_id, symbol, CASE WHEN n = 20 THEN round(middle, 6) END AS middle,
       CASE WHEN n = 20 THEN round(middle + 2 * spread, 6) END AS upper,
       CASE WHEN n = 20 THEN round(middle - 2 * spread, 6) END AS lower
FROM stats""",
        "ticks",
    )
)
def bollinger(spark: SparkSession, folder: str) -> DataFrame:
    return _on_ticks(spark, folder, I.bollinger, "middle", "upper", "lower")


_VOLATILITY_SQL = sql(
    """
WITH steps AS (
  SELECT trade_id, symbol, ts,
         ln(nullif(CAST(price AS DOUBLE), 0) / nullif(CAST(lag(price) OVER w AS DOUBLE), 0))
           AS step
  FROM ticks WINDOW w AS (PARTITION BY symbol ORDER BY ts, trade_id))
SELECT trade_id, symbol,
       CASE WHEN count(step) OVER f = 20 THEN round(stddev_samp(step) OVER f, 6) END AS volatility
FROM steps
WINDOW f AS (PARTITION BY symbol ORDER BY ts, trade_id ROWS 19 PRECEDING)""",
    "ticks",
)


@query(_VOLATILITY_SQL)
def volatility(spark: SparkSession, folder: str) -> DataFrame:
    return _on_ticks(spark, folder, I.volatility, "volatility")


@query(_VOLATILITY_SQL)
def volatility_hot(spark: SparkSession, folder: str) -> DataFrame:
    return _on_ticks(
        spark, folder, I.volatility, "volatility", rows_per_task=_hot(spark, folder)
    )


@query(
    sql(
        """
WITH ranges AS (
  SELECT symbol, bar, count(*) OVER f AS n, CAST(close AS DOUBLE) AS c,
         CAST(min(low) OVER f AS DOUBLE) AS lo, CAST(max(high) OVER f AS DOUBLE) AS hi
  FROM hour_bars
  WINDOW f AS (PARTITION BY symbol ORDER BY bar ROWS 13 PRECEDING)),
k AS (
  SELECT symbol, bar, CASE WHEN n = 14 AND hi > lo THEN (c - lo) * 100 / (hi - lo) END AS k
  FROM ranges)
SELECT symbol, bar, round(k, 6) AS percent_k,
       CASE WHEN count(k) OVER f = 3 THEN round(avg(k) OVER f, 6) END AS percent_d
FROM k WINDOW f AS (PARTITION BY symbol ORDER BY bar ROWS 2 PRECEDING)""",
        "hour_bars",
    )
)
def stochastic(spark: SparkSession, folder: str) -> DataFrame:
    return _on_bars(spark, folder, I.stochastic, "percent_k", "percent_d")


_WIDE = 150
"""Rows of a wide frame: over half the trades of a symbol in the small tables."""


@query(
    sql(
        f"""
WITH stats AS (
  SELECT trade_id, symbol, count(*) OVER f AS n,
         CAST(sum(price) OVER f AS DOUBLE) / {_WIDE} AS middle,
         stddev_pop(CAST(price AS DOUBLE)) OVER f AS spread
  FROM ticks
  WINDOW f AS (PARTITION BY symbol ORDER BY ts, trade_id ROWS {_WIDE - 1} PRECEDING))
SELECT trade_id, symbol, CASE WHEN n = {_WIDE} THEN round(middle, 6) END AS middle,
       CASE WHEN n = {_WIDE} THEN round(middle + 2 * spread, 6) END AS upper,
       CASE WHEN n = {_WIDE} THEN round(middle - 2 * spread, 6) END AS lower
FROM stats""",
        "ticks",
    )
)
def bollinger_wide(spark: SparkSession, folder: str) -> DataFrame:
    return _on_ticks(spark, folder, I.bollinger, "middle", "upper", "lower", n=_WIDE)


@query(_VOLATILITY_SQL.replace("= 20", f"= {_WIDE}").replace("ROWS 19", f"ROWS {_WIDE - 1}"))
def volatility_wide_hot(spark: SparkSession, folder: str) -> DataFrame:
    """A frame that is as long as a chunk."""
    return _on_ticks(spark, folder, I.volatility, "volatility", n=_WIDE, rows_per_task=_hot(spark, folder))


_STOCHASTIC_WIDE_SQL = sql(
    f"""
WITH ranges AS (
  SELECT symbol, bar, count(*) OVER f AS n, CAST(close AS DOUBLE) AS c,
         CAST(min(low) OVER f AS DOUBLE) AS lo, CAST(max(high) OVER f AS DOUBLE) AS hi
  FROM hour_bars
  WINDOW f AS (PARTITION BY symbol ORDER BY bar ROWS {_WIDE - 1} PRECEDING)),
k AS (
  SELECT symbol, bar, CASE WHEN n = {_WIDE} AND hi > lo THEN (c - lo) * 100 / (hi - lo) END AS k
  FROM ranges)
SELECT symbol, bar, round(k, 6) AS percent_k,
       CASE WHEN count(k) OVER f = 3 THEN round(avg(k) OVER f, 6) END AS percent_d
FROM k WINDOW f AS (PARTITION BY symbol ORDER BY bar ROWS 2 PRECEDING)""",
    "hour_bars",
)


@query(_STOCHASTIC_WIDE_SQL)
def stochastic_wide(spark: SparkSession, folder: str) -> DataFrame:
    return _on_bars(spark, folder, I.stochastic, "percent_k", "percent_d", n=_WIDE)


@query(_STOCHASTIC_WIDE_SQL)
def stochastic_wide_hot(spark: SparkSession, folder: str) -> DataFrame:
    """The frame goes back over several chunks."""
    return _on_bars(spark, folder, I.stochastic, "percent_k", "percent_d", n=_WIDE, rows_per_task=HOT_BARS)


_VWAP_SQL = sql(
    """
SELECT trade_id, symbol,
       round(CAST(sum(price * qty) OVER r AS DOUBLE)
             / nullif(CAST(sum(qty) OVER r AS DOUBLE), 0), 6) AS vwap
FROM (SELECT *, CAST(ts + INTERVAL 330 MINUTE AS DATE) AS day FROM ticks)
WINDOW r AS (PARTITION BY symbol, day ORDER BY ts, trade_id ROWS UNBOUNDED PRECEDING)""",
    "ticks",
)


def _vwap(spark: SparkSession, folder: str, **how) -> DataFrame:
    rows = V.ticks(spark, folder).withColumn("day", exchange_day(F.col("ts")))
    done = I.vwap(rows, "symbol", "day", TICK_ORDER, **how)
    return done.select("trade_id", "symbol", _digits(done, "vwap"))


@query(_VWAP_SQL)
def vwap(spark: SparkSession, folder: str) -> DataFrame:
    return _vwap(spark, folder)


@query(_VWAP_SQL)
def vwap_hot(spark: SparkSession, folder: str) -> DataFrame:
    return _vwap(spark, folder, rows_per_task=HOT_DAY)


_OBV_SQL = sql(
    f"""
WITH flows AS (
  SELECT symbol, bar,
         CASE WHEN close > lag(close) OVER w THEN volume
              WHEN close < lag(close) OVER w THEN -volume ELSE 0 END AS flow
  FROM hour_bars {BAR_WINDOW})
SELECT symbol, bar, CAST(sum(flow) OVER (
         PARTITION BY symbol ORDER BY bar ROWS UNBOUNDED PRECEDING) AS BIGINT) AS obv
FROM flows""",
    "hour_bars",
)


@query(_OBV_SQL)
def obv(spark: SparkSession, folder: str) -> DataFrame:
    return _on_bars(spark, folder, I.obv, "obv")


@query(_OBV_SQL)
def obv_hot(spark: SparkSession, folder: str) -> DataFrame:
    return _on_bars(spark, folder, I.obv, "obv", rows_per_task=HOT_BARS)


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
SELECT trade_id, symbol, round(ema, 6) AS ema FROM chain""",
    "ticks",
    recursive=True,
)


@query(_EMA_SQL)
def ema(spark: SparkSession, folder: str) -> DataFrame:
    return _on_ticks(spark, folder, I.ema, "ema")


@query(_EMA_SQL)
def ema_hot(spark: SparkSession, folder: str) -> DataFrame:
    return _on_ticks(spark, folder, I.ema, "ema", rows_per_task=_hot(spark, folder))


_MACD_SQL = sql(
    """
WITH numbered AS (
  SELECT trade_id, symbol, CAST(price AS DOUBLE) AS p,
         row_number() OVER (PARTITION BY symbol ORDER BY ts, trade_id) AS place
  FROM ticks),
chain AS (
  SELECT trade_id, symbol, place, p AS fast, p AS slow FROM numbered WHERE place = 1
  UNION ALL
  SELECT t.trade_id, t.symbol, t.place, c.fast + (2::DOUBLE / 13) * (t.p - c.fast),
         c.slow + (2::DOUBLE / 27) * (t.p - c.slow)
  FROM chain c JOIN numbered t ON t.symbol = c.symbol AND t.place = c.place + 1),
lines AS (SELECT trade_id, symbol, place, fast - slow AS line FROM chain),
signals AS (
  SELECT trade_id, symbol, place, line, line AS signal FROM lines WHERE place = 1
  UNION ALL
  SELECT t.trade_id, t.symbol, t.place, t.line, c.signal + (2::DOUBLE / 10) * (t.line - c.signal)
  FROM signals c JOIN lines t ON t.symbol = c.symbol AND t.place = c.place + 1)
SELECT trade_id, symbol, round(line, 6) AS macd, round(signal, 6) AS macd_signal,
       round(line - signal, 6) AS macd_histogram
FROM signals""",
    "ticks",
    recursive=True,
)


@query(_MACD_SQL)
def macd(spark: SparkSession, folder: str) -> DataFrame:
    return _on_ticks(spark, folder, I.macd, "macd", "macd_signal", "macd_histogram")


@query(_MACD_SQL)
def macd_hot(spark: SparkSession, folder: str) -> DataFrame:
    outputs = ("macd", "macd_signal", "macd_histogram")
    return _on_ticks(spark, folder, I.macd, *outputs, rows_per_task=_hot(spark, folder))


@query(
    sql(
        """
WITH numbered AS (
  SELECT trade_id, symbol, CASE WHEN extract(hour FROM ts) % 3 = 0 THEN CAST(price AS DOUBLE) END AS p,
         row_number() OVER (PARTITION BY symbol ORDER BY ts, trade_id) AS place
  FROM ticks),
chain AS (
  SELECT trade_id, symbol, place, p AS ema FROM numbered WHERE place = 1
  UNION ALL
  SELECT t.trade_id, t.symbol, t.place,
         CASE WHEN t.p IS NULL THEN c.ema WHEN c.ema IS NULL THEN t.p
              ELSE c.ema + (2::DOUBLE / 13) * (t.p - c.ema) END
  FROM chain c JOIN numbered t ON t.symbol = c.symbol AND t.place = c.place + 1)
SELECT trade_id, symbol, round(ema, 6) AS ema FROM chain""",
        "ticks",
        recursive=True,
    )
)
def ema_gaps_hot(spark: SparkSession, folder: str) -> DataFrame:
    """Two hours of three have no price."""
    rows = V.ticks(spark, folder).withColumn("price", F.when(F.hour("ts") % 3 == 0, F.col("price")))
    done = I.ema(rows, "symbol", TICK_ORDER, rows_per_task=_hot(spark, folder))
    return done.select("trade_id", "symbol", _digits(done, "ema"))


_RSI_SQL = """
WITH moves AS (
  SELECT trade_id, symbol, row_number() OVER w AS place,
         CAST({price} - lag({price}) OVER w AS DOUBLE) AS move
  FROM ticks WINDOW w AS (PARTITION BY symbol ORDER BY ts, trade_id)),
means AS (
  SELECT *, count(*) FILTER (move > 0) OVER s AS rises, count(*) FILTER (move < 0) OVER s AS falls,
         greatest(move, 0) AS gain, greatest(-move, 0) AS loss,
         avg(greatest(move, 0)) OVER f AS gain0, avg(greatest(-move, 0)) OVER f AS loss0
  FROM moves
  WINDOW f AS (PARTITION BY symbol ORDER BY place ROWS 13 PRECEDING),
         s AS (PARTITION BY symbol ORDER BY place ROWS UNBOUNDED PRECEDING)),
chain AS (
  SELECT trade_id, symbol, place, rises, falls, gain0 AS up, loss0 AS down FROM means WHERE place = 15
  UNION ALL
  SELECT t.trade_id, t.symbol, t.place, t.rises, t.falls, (c.up * 13 + t.gain) / 14, (c.down * 13 + t.loss) / 14
  FROM chain c JOIN means t ON t.symbol = c.symbol AND t.place = c.place + 1)
SELECT m.trade_id, m.symbol,
       round(CASE WHEN rises + falls = 0 THEN 50 WHEN falls = 0 THEN 100
                  ELSE 100 - 100 / (1 + c.up / c.down) END, 6) AS rsi
FROM moves m LEFT JOIN chain c ON m.trade_id = c.trade_id"""


@query(sql(_RSI_SQL.format(price="price"), "ticks", recursive=True))
def rsi(spark: SparkSession, folder: str) -> DataFrame:
    return _on_ticks(spark, folder, I.rsi, "rsi")


@query(sql(_RSI_SQL.format(price="price"), "ticks", recursive=True))
def rsi_hot(spark: SparkSession, folder: str) -> DataFrame:
    return _on_ticks(spark, folder, I.rsi, "rsi", rows_per_task=_hot(spark, folder))


_HALTED = "CAST(CASE WHEN extract(day FROM ts) % 2 = 0 THEN price ELSE 10 END AS DECIMAL(18,4))"


@query(sql(_RSI_SQL.format(price=_HALTED), "ticks", recursive=True))
def rsi_flat_hot(spark: SparkSession, folder: str) -> DataFrame:
    """Every other day the price stands still."""
    still = F.when(F.dayofmonth("ts") % 2 == 0, F.col("price")).otherwise(F.lit(10))
    rows = V.ticks(spark, folder).withColumn("price", still.cast("decimal(18,4)"))
    done = I.rsi(rows, "symbol", TICK_ORDER, rows_per_task=_hot(spark, folder))
    return done.select("trade_id", "symbol", _digits(done, "rsi"))


_STEPS = "CAST(10 + least(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)), 4) AS DECIMAL(18,4))"


@query(sql(_RSI_SQL.format(price=_STEPS), "ticks", recursive=True))
def rsi_halt_hot(spark: SparkSession, folder: str) -> DataFrame:
    """The price rises on four days and then stands still for good: never a loss."""
    steps = F.least(F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")), F.lit(4)) + 10
    rows = V.ticks(spark, folder).withColumn("price", steps.cast("decimal(18,4)"))
    done = I.rsi(rows, "symbol", TICK_ORDER, rows_per_task=_hot(spark, folder))
    return done.select("trade_id", "symbol", _digits(done, "rsi"))


_ATR_SQL = sql(
    """
WITH ranges AS (
  SELECT symbol, bar, row_number() OVER w AS place,
         CAST(greatest(high - low, abs(high - lag(close) OVER w), abs(low - lag(close) OVER w))
              AS DOUBLE) AS reach
  FROM hour_bars WINDOW w AS (PARTITION BY symbol ORDER BY bar)),
means AS (
  SELECT *, avg(reach) OVER (PARTITION BY symbol ORDER BY bar ROWS 13 PRECEDING) AS mean
  FROM ranges),
chain AS (
  SELECT symbol, bar, place, mean AS atr FROM means WHERE place = 14
  UNION ALL
  SELECT t.symbol, t.bar, t.place, (c.atr * 13 + t.reach) / 14
  FROM chain c JOIN means t ON t.symbol = c.symbol AND t.place = c.place + 1)
SELECT r.symbol, r.bar, round(c.atr, 6) AS atr
FROM ranges r LEFT JOIN chain c ON r.symbol = c.symbol AND r.bar = c.bar""",
    "hour_bars",
    recursive=True,
)


@query(_ATR_SQL)
def atr(spark: SparkSession, folder: str) -> DataFrame:
    return _on_bars(spark, folder, I.atr, "atr")


@query(_ATR_SQL)
def atr_hot(spark: SparkSession, folder: str) -> DataFrame:
    return _on_bars(spark, folder, I.atr, "atr", rows_per_task=HOT_BARS)
