"""Queries for normalisation, validation and cleansing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import rules as R
from tickloom.functions.timing import plain
from tickloom.operators import normalize as N
from tickloom.operators import validate as C
from tickloom.operators.indicators import price_change
from tickloom.plans import views as V
from tickloom.plans.chain import run_steps
from tickloom.plans.registry import query
from tickloom.plans.views import sql
from tickloom.workspace import new_folder

_LOCAL_DAY = "CAST(bar + INTERVAL 330 MINUTE AS DATE)"


@query(
    sql(
        f"""
SELECT symbol, 'EQ' AS series, {_LOCAL_DAY} AS date, bar AS timestamp, open, high, low, close,
       close AS last, open AS prev_close, volume AS total_traded_quantity,
       CAST(value AS DECIMAL(18,2)) AS total_traded_value, trades AS total_trades,
       CAST(NULL AS VARCHAR) AS isin, 0 AS n_errors
FROM hour_bars""",
        "hour_bars",
    )
)
def normalize_equity(spark: SparkSession, folder: str) -> DataFrame:
    rows = N.normalize_equity(V.raw_equity(spark, folder))
    return rows.withColumns(
        {"timestamp": plain(F.col("timestamp")), "n_errors": F.size(N.TYPE_ERRORS)}
    ).drop(N.TYPE_ERRORS)


@query(
    sql(
        f"""
SELECT symbol, CAST(bar AS DATE) + 30 AS expiry_date, 'FUTIDX' AS instrument_type,
       CAST(0 AS DECIMAL(18,4)) AS strike_price, '' AS option_type, {_LOCAL_DAY} AS date,
       bar AS timestamp, open, high, low, close, close AS last, open AS prev_close, volume,
       CAST(value AS DECIMAL(18,2)) AS value, volume * 10 AS open_interest,
       volume - 50 AS change_in_oi, 0 AS n_errors
FROM hour_bars""",
        "hour_bars",
    )
)
def normalize_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = N.normalize_derivatives(V.raw_derivatives(spark, folder))
    return rows.withColumns(
        {"timestamp": plain(F.col("timestamp")), "n_errors": F.size(N.TYPE_ERRORS)}
    ).drop(N.TYPE_ERRORS)


@query(
    sql(
        """
SELECT trade_id, CASE WHEN qty <> 0 THEN price END AS close,
       CASE WHEN qty > 2 THEN qty END AS total_traded_quantity,
       concat_ws(',', CASE WHEN qty = 0 THEN 'close' END,
                 CASE WHEN qty <= 2 THEN 'total_traded_quantity' END) AS type_errors
FROM ticks""",
        "ticks",
    )
)
def typed_projection(spark: SparkSession, folder: str) -> DataFrame:
    quantity = F.col("qty").cast("string")
    raw = V.ticks(spark, folder).select(
        "trade_id",
        F.when(F.col("qty") == 0, "n/a").otherwise(F.col("price").cast("string")).alias("close"),
        F.when(F.col("qty") > 2, quantity).otherwise("many").alias("total_traded_quantity"),
    )
    typed = N.apply_types(raw, "equity")
    return typed.withColumn(N.TYPE_ERRORS, F.array_join(N.TYPE_ERRORS, ","))


@query(
    sql(
        """
SELECT trade_id, date_trunc('milliseconds', ts) AS timestamp,
       CAST(ts + INTERVAL 330 MINUTE AS DATE) AS date
FROM ticks""",
        "ticks",
    )
)
def parse_event_time(spark: SparkSession, folder: str) -> DataFrame:
    local = F.col("ts") + F.expr("INTERVAL '05:30' HOUR TO MINUTE")
    text = F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+05:30'")
    raw = V.ticks(spark, folder).select("trade_id", text.alias("sent"))
    parsed = N.parse_event_time(raw, "sent")
    return parsed.select("trade_id", plain(F.col("timestamp")).alias("timestamp"), "date")


@query(
    """
SELECT p_partkey, upper(p_brand) AS symbol, upper(p_type) AS instrument_type,
       CASE WHEN p_size % 2 = 0 THEN 'CE' END AS option_type,
       CAST(nullif(p_size % 5, 0) AS DECIMAL(18,4)) AS strike_price
FROM part"""
)
def canonical_keys(spark: SparkSession, folder: str) -> DataFrame:
    parts = V.table(spark, folder, "part").select(
        "p_partkey",
        F.concat(F.lit("  "), "p_brand", F.lit(" ")).alias("symbol"),
        F.lower("p_type").alias("instrument_type"),
        F.when(F.col("p_size") % 2 == 0, " ce ").otherwise(" ").alias("option_type"),
        (F.col("p_size") % 5).cast("decimal(18,4)").alias("strike_price"),
    )
    return N.canonical_keys(parts)


@query(
    sql(
        """
SELECT log_level, component, message, timestamp FROM log_rows
WHERE upper(log_level) IN ('WARNING', 'ERROR', 'CRITICAL')""",
        "log_rows",
    )
)
def logs_at_or_above(spark: SparkSession, folder: str) -> DataFrame:
    kept = N.logs_at_or_above(V.log_rows(spark, folder), "warning").drop("extra")
    return kept.withColumn("timestamp", plain(F.col("timestamp")))


@query(
    sql(
        """
SELECT trade_id,
       'qty=' || qty || ',symbol=' || symbol || ',user=' ||
       CASE WHEN qty % 2 = 0 THEN 'hidden' ELSE CAST(user_id AS VARCHAR) END AS merged
FROM ticks""",
        "ticks",
    )
)
def merge_extra(spark: SparkSession, folder: str) -> DataFrame:
    computed = F.create_map(
        F.lit("user"), F.col("user_id").cast("string"), F.lit("symbol"), F.col("symbol")
    )
    quantity = [F.lit("qty"), F.col("qty").cast("string")]
    extra = F.when(
        F.col("qty") % 2 == 0, F.create_map(*quantity, F.lit("user"), F.lit("hidden"))
    ).otherwise(F.create_map(*quantity))
    merged = V.ticks(spark, folder).select(
        "trade_id", N.merge_extra(computed, extra).alias("merged")
    )
    entries = F.transform(
        F.array_sort(F.map_entries("merged")), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return merged.withColumn("merged", F.array_join(entries, ","))


@query(
    sql(
        """
SELECT log_level, message, 'loader' AS service, '0.1.0' AS version,
       'production' AS environment, 'data_processing' AS component, timestamp
FROM log_rows""",
        "log_rows",
    )
)
def attach_context(spark: SparkSession, folder: str) -> DataFrame:
    rows = V.log_rows(spark, folder).drop("extra")
    done = N.attach_context(rows, "loader", "0.1.0", "production", "data_processing")
    return done.withColumn("timestamp", plain(F.col("timestamp")))


# Validation -----------------------------------------------------------------------------

_ROW = ["source", "mark", "copy"]


def single_row_rules() -> dict[str, Column]:
    return {
        "required": R.blank("symbol") | R.missing("timestamp"),
        "type": R.uncastable(*[(f"raw_{c}", c) for c in ("open", "high", "low", "close")]),
        "range": R.out_of_range("open", "high", "low", "close", "volume", "open_interest"),
        "price_bounds": R.outside_bounds("open", "close"),
        "value": R.implausible_value("value", "volume"),
        "leg": R.wrong_leg(),
    }


def _failing(spark: SparkSession, folder: str, rule: str, *shown: str) -> DataFrame:
    rows = V.typed_bars(spark, folder).filter(single_row_rules()[rule])
    return rows.select(*_ROW, *shown)


def _failing_sql(rule: str, *shown: str) -> str:
    columns = ", ".join([*_ROW, *shown])
    return sql(f"SELECT {columns} FROM failures WHERE f_{rule}", "failures")


@query(_failing_sql("required", "symbol"))
def invalid_required(spark: SparkSession, folder: str) -> DataFrame:
    return _failing(spark, folder, "required", "symbol")


@query(_failing_sql("type", "raw_close"))
def invalid_type(spark: SparkSession, folder: str) -> DataFrame:
    return _failing(spark, folder, "type", "raw_close")


@query(_failing_sql("range", "open"))
def invalid_range(spark: SparkSession, folder: str) -> DataFrame:
    return _failing(spark, folder, "range", "open")


@query(_failing_sql("price_bounds", "open", "high", "low", "close"))
def invalid_ohlc(spark: SparkSession, folder: str) -> DataFrame:
    return _failing(spark, folder, "price_bounds", "open", "high", "low", "close")


@query(_failing_sql("value", "value", "volume"))
def invalid_value(spark: SparkSession, folder: str) -> DataFrame:
    return _failing(spark, folder, "value", "value", "volume")


@query(_failing_sql("leg", "instrument_type", "strike_price", "option_type"))
def invalid_leg(spark: SparkSession, folder: str) -> DataFrame:
    return _failing(spark, folder, "leg", "instrument_type", "strike_price", "option_type")


def _with_derived(rows: DataFrame) -> DataFrame:
    return C.check_derived(
        rows,
        "symbol",
        ["timestamp", "source", "copy"],
        points=("close", "points_change", None),
        interest=("open_interest", "change_in_oi"),
    )


@query(_failing_sql("derived", "close", "points_change", "change_in_oi"))
def invalid_derived(spark: SparkSession, folder: str) -> DataFrame:
    rows = _with_derived(V.typed_bars(spark, folder)).filter("derived_fails")
    return rows.select(*_ROW, "close", "points_change", "change_in_oi")


@query(
    sql(
        """
WITH changed AS (
  SELECT symbol, bar, close, CAST(close - prev AS DECIMAL(18,4)) AS points,
         CAST(100 * (close - prev) AS DOUBLE) / CAST(prev AS DOUBLE) AS percent
  FROM (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY bar) AS prev FROM hour_bars)
  WHERE prev IS NOT NULL)
SELECT symbol, bar, close, points FROM changed WHERE abs(round(percent, 1) - percent) > 0.01""",
        "hour_bars",
    )
)
def invalid_percent(spark: SparkSession, folder: str) -> DataFrame:
    """Index rows whose percent change was stored with one digit only."""
    changed = price_change(V.hour_bars(spark, folder), "symbol", "bar", "close")
    stored = changed.withColumns(
        {
            "points_change": F.col("change").cast("decimal(18,4)"),
            "percent_change": F.round("change_pct", 1).cast("decimal(18,4)"),
        }
    )
    failed = C.check_derived(stored, "symbol", "bar").filter("derived_fails")
    return failed.select(
        plain(F.col("bar")).alias("bar"), "symbol", "close", F.col("points_change").alias("points")
    )


@query(
    """
SELECT * FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_shipdate,
         count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies
  FROM lineitem)
WHERE copies > 1"""
)
def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    lines = V.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_shipdate"
    )
    return C.duplicate_rows(lines, ["l_orderkey", "l_linenumber"])


@query(
    """
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice
FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
             l_extendedprice DESC) AS place
  FROM lineitem)
WHERE place = 1"""
)
def dedup_latest(spark: SparkSession, folder: str) -> DataFrame:
    lines = V.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice",
    )
    return C.dedup_latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query(
    sql(
        """
SELECT metric_name, max(date_trunc('milliseconds', timestamp)) AS timestamp, count(*) > 0 AS has_labels
FROM metric_rows GROUP BY metric_name""",
        "metric_rows",
    )
)
def dedup_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The newest figure of each metric, labels and all, from a table that holds each twice."""
    rows = V.metric_rows(spark, folder)
    newest = C.dedup_latest(rows.unionByName(rows), ["metric_name"], ["timestamp"])
    return newest.select(
        "metric_name",
        plain(F.date_trunc("millisecond", "timestamp")).alias("timestamp"),
        (F.size("labels") > 0).alias("has_labels"),
    )


def checked(spark: SparkSession, folder: str) -> DataFrame:
    """All rules, the two that look at other rows included."""
    rows = _with_derived(V.typed_bars(spark, folder))
    rows = C.count_copies(rows, ["symbol", "instrument_type", "timestamp"])
    rules = {
        **single_row_rules(),
        "derived": F.col("derived_fails"),
        "duplicate": F.col(C.COPIES) > 1,
    }
    return C.validate(rows, rules)


_NAMES = ["required", "type", "range", "price_bounds", "value", "leg", "derived", "duplicate"]
_LIST = "[" + ", ".join(f"CASE WHEN f_{n} THEN '{n}' END" for n in _NAMES) + "]"
REASONS_SQL = f"array_to_string(list_filter({_LIST}, lambda x: x IS NOT NULL), ',')"


@query(
    sql(
        f"""
SELECT * FROM (SELECT source, mark, copy, volume, {REASONS_SQL} AS reasons FROM failures)
WHERE reasons <> ''""",
        "failures",
    )
)
def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    _, bad = C.split_valid(checked(spark, folder))
    return bad.select(*_ROW, "volume", F.array_join(C.REASONS, ",").alias("reasons"))


@query(
    sql(
        f"""
SELECT source, mark, copy, open, high, low, close, volume, value
FROM (SELECT *, {REASONS_SQL} AS reasons FROM failures)
WHERE reasons = ''""",
        "failures",
    )
)
def valid_rows(spark: SparkSession, folder: str) -> DataFrame:
    good, _ = C.split_valid(checked(spark, folder))
    return good.select(*_ROW, "open", "high", "low", "close", "volume", "value")


@query(
    sql(
        f"""
SELECT source, count(*) FILTER ({REASONS_SQL} = '') AS valid, count(*) FILTER ({REASONS_SQL} <> '') AS quarantined,
       CAST(sum(volume) FILTER ({REASONS_SQL} = '') AS BIGINT) AS valid_volume
FROM failures GROUP BY source""",
        "failures",
    )
)
def quarantine_split(spark: SparkSession, folder: str) -> DataFrame:
    """Both sides of the rules, written by one run."""
    good, bad = C.write_split(checked(spark, folder), new_folder(spark, "checked"))
    valid = good.groupBy("source").agg(F.count(F.lit(1)).alias("valid"), F.sum("volume").alias("valid_volume"))
    found = valid.join(bad.groupBy("source").agg(F.count(F.lit(1)).alias("quarantined")), "source", "full")
    return found.select("source", F.coalesce("valid", F.lit(0)).alias("valid"), F.coalesce("quarantined", F.lit(0)).alias("quarantined"), "valid_volume")


@query(
    sql(
        f"""
SELECT source, rule, count(*) AS rows_failed
FROM (SELECT source, unnest(string_split({REASONS_SQL}, ',')) AS rule FROM failures)
WHERE rule <> ''
GROUP BY source, rule""",
        "failures",
    )
)
def rule_summary(spark: SparkSession, folder: str) -> DataFrame:
    return C.rule_summary(checked(spark, folder), ["source"])


@query(
    sql(
        f"""
SELECT source, count(*) AS records_processed,
       round(count(*) FILTER ({REASONS_SQL} = '') / count(*), 6) AS success_rate
FROM failures GROUP BY source""",
        "failures",
    )
)
def batch_success(spark: SparkSession, folder: str) -> DataFrame:
    rates = C.batch_success(checked(spark, folder), ["source"])
    return rates.withColumn("success_rate", F.round("success_rate", 6))


@query(
    sql(
        """
SELECT symbol, count(*) AS n, CAST(sum(price) AS DECIMAL(28,4)) AS price_sum
FROM (SELECT upper(symbol) AS symbol, price, qty FROM ticks)
WHERE qty > 0 GROUP BY symbol""",
        "ticks",
    )
)
def chained_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Library and user steps in a row: clean keys, validate, keep valid rows, summarise."""

    def check(df: DataFrame) -> DataFrame:
        return C.validate(df, {"traded": F.col("qty") <= 0, "range": R.out_of_range("price")})

    def keep_valid(df: DataFrame) -> DataFrame:
        return C.split_valid(df)[0]

    def summarise(df: DataFrame) -> DataFrame:
        return df.groupBy("symbol").agg(
            F.count(F.lit(1)).alias("n"), F.sum("price").alias("price_sum")
        )

    return run_steps(V.ticks(spark, folder), [N.canonical_keys, check, keep_valid, summarise])
