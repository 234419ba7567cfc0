"""Queries for market figures, metrics, health and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.timing import plain
from tickloom.operators import market as K
from tickloom.operators import monitor as M
from tickloom.operators import rollups as U
from tickloom.operators.ordered import ordered
from tickloom.plans import views as V
from tickloom.plans.registry import query
from tickloom.plans.views import sql
from tickloom.sources import logs, tables
from tickloom.workspace import new_folder


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


_SPEED = "records_processed / processing_time"
_BATCH_SEVERITY = f"""
CASE WHEN success_rate < 0.95 THEN 'error' WHEN success_rate < 0.99 THEN 'warning'
     WHEN processing_time <= 0 OR {_SPEED} < 100 THEN 'warning' ELSE 'info' END"""


@query(
    sql(
        f"""
SELECT operation, records_processed, round(processing_time, 3) AS processing_time_s,
       round(success_rate, 4) AS success_rate,
       CASE WHEN processing_time > 0 THEN round({_SPEED}, 2) ELSE 0.0::DOUBLE END
         AS records_per_second,
       'batch_processing' AS operation_type
FROM batches""",
        "batches",
    )
)
def batch_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return M.batch_metrics(V.batches(spark, folder)).drop(
        "processing_time", "severity", "message"
    )


@query(sql(f"SELECT operation, {_BATCH_SEVERITY} AS severity FROM batches", "batches"))
def batch_severity(spark: SparkSession, folder: str) -> DataFrame:
    return M.batch_metrics(V.batches(spark, folder)).select("operation", "severity")


@query(
    sql(
        """
SELECT operation, printf('Batch %s: %d records processed in %.3fs (%.2f%% success rate)',
       operation, records_processed, processing_time, round(success_rate * 100, 2)) AS message
FROM batches""",
        "batches",
    )
)
def batch_message(spark: SparkSession, folder: str) -> DataFrame:
    return M.batch_metrics(V.batches(spark, folder)).select("operation", "message")


@query(
    sql(
        """
SELECT operation, records_processed, CAST(round(success_rate, 4) AS VARCHAR) AS rate_field,
       'batch_processing' AS type_field,
       CASE WHEN records_processed > 4 THEN 'bulk' ELSE operation END AS operation_field
FROM batches""",
        "batches",
    )
)
def batch_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Batch fields with an extra that renames large batches."""
    large = F.col("records_processed") > 4
    rows = V.batches(spark, folder).withColumn(
        "extra", F.when(large, F.create_map(F.lit("operation"), F.lit("bulk")))
    )
    fields = F.col("fields")
    return M.batch_metrics(rows).select(
        "operation",
        "records_processed",
        fields["success_rate"].alias("rate_field"),
        fields["operation_type"].alias("type_field"),
        fields["operation"].alias("operation_field"),
    )


@query(
    sql(
        """
SELECT request_id, method, path, status_code, round(response_time, 2) AS response_time_ms,
       'http' AS request_type,
       printf('%s %s - %d (%.2fms)', method, path, status_code, round(response_time, 2))
         AS message
FROM requests""",
        "requests",
    )
)
def request_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return M.request_metrics(V.requests(spark, folder)).drop(
        "response_time", "timestamp", "props", "severity"
    )


@query(
    sql(
        """
SELECT request_id, CAST(round(response_time, 2) AS DECIMAL(18,2)) AS time_field, 'http' AS type_field,
       CASE WHEN status_code >= 500 THEN 'failed' ELSE path END AS path_field, CAST(status_code AS VARCHAR) AS status_field
FROM requests""",
        "requests",
    )
)
def request_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Request fields with an extra that renames the path of failures."""
    failed = F.col("status_code") >= 500
    rows = V.requests(spark, folder).withColumn(
        "extra", F.when(failed, F.create_map(F.lit("path"), F.lit("failed")))
    )
    fields = F.col("fields")
    return M.request_metrics(rows).select(
        "request_id",
        fields["response_time_ms"].cast("decimal(18,2)").alias("time_field"),
        fields["request_type"].alias("type_field"),
        fields["path"].alias("path_field"),
        fields["status_code"].alias("status_field"),
    )


@query(
    sql(
        """
SELECT CASE WHEN status_code >= 500 THEN 'ERROR' WHEN status_code >= 400 THEN 'WARNING'
            WHEN response_time > 1000 THEN 'WARNING' ELSE 'INFO' END AS log_level,
       'api' AS component, CAST(request_id AS VARCHAR) AS request_id, path AS path_field, count(*) AS n
FROM requests GROUP BY ALL""",
        "requests",
    )
)
def metrics_to_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Request metrics written to the table of logs and read back."""
    rows = V.requests(spark, folder).withColumn("extra", F.lit(None).cast("map<string,string>"))
    base = new_folder(spark, "processing_logs")
    logs_ = M.metrics_to_logs(M.request_metrics(rows), "api")
    tables.write_table(logs_, base, "processing_logs", V.LOADED)
    stored = tables.read_table(spark, base, "processing_logs")
    shown = stored.select("log_level", "component", F.col("extra")["request_id"].alias("request_id"), F.col("extra")["path"].alias("path_field"))
    return shown.groupBy(*shown.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    sql(
        """
SELECT doc_id, 'INFO' AS log_level, source AS component, text AS message, CAST(n_chars AS VARCHAR) AS line, TRUE AS readable
FROM documents"""
    )
)
def format_json_line(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as log messages, written as lines and parsed again: nothing is lost."""
    docs = V.table(spark, folder, "documents")
    line = logs.format_json_line(
        timestamp=F.to_timestamp(F.lit(V.LOADED)), level=F.lit("INFO"), service=F.lit("loader"), version=F.lit("1"),
        environment=F.lit("test"), module=F.col("source"), function=F.lit("load"), line=F.col("n_chars"), message=F.col("text"),
    )
    parsed = logs.parse_json_logs(docs.select("doc_id", line.alias("line")), "line", "doc_id")
    return parsed.select(
        "doc_id", "log_level", "component", "message", F.col("extra")["line"].alias("line"), F.col(logs.CORRUPT).isNull().alias("readable")
    )


@query(
    sql(
        """
SELECT request_id,
       CASE WHEN status_code >= 500 THEN 'error' WHEN status_code >= 400 THEN 'warning'
            WHEN response_time > 1000 THEN 'warning' ELSE 'info' END AS severity
FROM requests""",
        "requests",
    )
)
def request_severity(spark: SparkSession, folder: str) -> DataFrame:
    return M.request_metrics(V.requests(spark, folder)).select("request_id", "severity")


_ROLLUP_SQL = sql(
    """
SELECT metric_name, shard, date_trunc('hour', timestamp) AS bucket, count(*) AS n,
       min(metric_value) AS min_value, max(metric_value) AS max_value,
       round(avg(metric_value), 6) AS avg_value,
       round(quantile_cont(metric_value, 0.95), 6) AS p95
FROM metric_rows GROUP BY ALL""",
    "metric_rows",
)


def _rollup(spark: SparkSession, folder: str, **how) -> DataFrame:
    rolled = M.metric_rollup(V.metric_rows(spark, folder), "shard", **how)
    return _rounded(rolled, "avg_value", "p95").withColumn("bucket", plain(F.col("bucket")))


@query(_ROLLUP_SQL)
def metric_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return _rollup(spark, folder)


_ERRORS_SQL = sql(
    """
SELECT date_trunc('hour', timestamp) AS bucket, count(*) AS requests,
       round(avg(CASE WHEN status_code >= 500 THEN 1.0::DOUBLE ELSE 0 END), 6) AS error_rate,
       round(quantile_cont(response_time, 0.5), 6) AS p50,
       round(quantile_cont(response_time, 0.95), 6) AS p95,
       round(quantile_cont(response_time, 0.99), 6) AS p99
FROM requests GROUP BY ALL""",
    "requests",
)


def _errors(spark: SparkSession, folder: str, width: str, **how) -> DataFrame:
    rates = M.error_rate(V.requests(spark, folder), width, **how)
    rates = _rounded(rates, "error_rate", "p50", "p95", "p99")
    return rates.withColumn("bucket", plain(F.col("bucket")))


@query(_ERRORS_SQL)
def error_rate(spark: SparkSession, folder: str) -> DataFrame:
    return _errors(spark, folder, "1 hour")


@query(_ERRORS_SQL.replace("date_trunc('hour', timestamp)", "date_trunc('day', timestamp)"))
def error_rate_hot(spark: SparkSession, folder: str) -> DataFrame:
    """Daily latencies with groups cut into chunks, as for groups larger than a task."""
    return _errors(spark, folder, "1 day", rows_per_task=12)


@query(
    sql(
        """
SELECT symbol AS feed, date_trunc('hour', ts) AS hour, count(*) AS records
FROM ticks GROUP BY ALL""",
        "ticks",
    )
)
def records_per_hour(spark: SparkSession, folder: str) -> DataFrame:
    rows = V.ticks(spark, folder).withColumnRenamed("symbol", "feed")
    return M.records_per_hour(rows, "feed", "ts").withColumn("hour", plain(F.col("hour")))


_NOW = "2024-01-31 00:00:00"


@query(
    sql(
        f"""
SELECT user_id, max(ts) AS last_seen,
       (epoch_us(TIMESTAMP '{_NOW}') - epoch_us(max(ts))) / 1000000.0::DOUBLE AS age_s,
       epoch_us(TIMESTAMP '{_NOW}') - epoch_us(max(ts)) > 30000000 AS is_stale
FROM ticks GROUP BY user_id""",
        "ticks",
    )
)
def freshness(spark: SparkSession, folder: str) -> DataFrame:
    ages = M.freshness(V.ticks(spark, folder), ["user_id"], _NOW, "ts")
    return ages.withColumn("last_seen", plain(F.col("last_seen")))


@query(
    sql(
        """
SELECT e.date, count(s.instrument) AS observed, count(*) AS expected,
       round(count(s.instrument) / count(*), 6) AS coverage
FROM expected_by_month e
LEFT JOIN (SELECT DISTINCT instrument, date FROM seen_by_month) s
  ON e.instrument = s.instrument AND e.date = s.date
GROUP BY e.date""",
        "expected_by_month",
    )
)
def coverage(spark: SparkSession, folder: str) -> DataFrame:
    found = K.coverage_by_span(
        V.listed_by_month(spark, folder), V.seen_by_month(spark, folder), "instrument", step="INTERVAL 1 MONTH"
    )
    return _rounded(found, "coverage")


@query(
    sql(
        """
WITH missing AS (
  SELECT instrument, date FROM expected_by_month EXCEPT SELECT instrument, date FROM seen_by_month),
islands AS (
  SELECT *, CAST(date AS TIMESTAMP) - to_months(CAST(row_number() OVER (PARTITION BY instrument ORDER BY date) AS INTEGER)) AS island
  FROM missing)
SELECT instrument, min(date) AS missing_from, max(date) AS missing_to FROM islands GROUP BY instrument, island""",
        "expected_by_month",
    )
)
def missing_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return K.missing_ranges(
        V.listed_by_month(spark, folder), V.seen_by_month(spark, folder), "instrument", step="INTERVAL 1 MONTH"
    )


@query(
    sql(
        """
SELECT instrument, date FROM expected_by_month
EXCEPT
SELECT instrument, date FROM seen_by_month""",
        "expected_by_month",
    )
)
def missing_instruments(spark: SparkSession, folder: str) -> DataFrame:
    """All of them by name, over the whole calendar; `missing_ranges` has the same as gaps."""
    return K.missing_instruments(
        V.expected_by_month(spark, folder), V.seen_by_month(spark, folder), "instrument"
    ).select("instrument", "date")


@query(
    sql(
        """
SELECT e.date, count(s.instrument) AS observed, count(*) AS expected,
       round(count(s.instrument) / count(*), 6) AS coverage
FROM expected_by_month e
LEFT JOIN (SELECT DISTINCT instrument, date FROM seen_by_month) s
  ON e.instrument = s.instrument AND e.date = s.date
GROUP BY e.date""",
        "expected_by_month",
    )
)
def coverage_by_bitmap(spark: SparkSession, folder: str) -> DataFrame:
    """Coverage out of the bitmaps of three loads, each written when it came."""
    path, listed = new_folder(spark, "seen"), V.listed_by_month(spark, folder)
    lines = V.table(spark, folder, "lineitem")
    for load in range(3):
        part = lines.where(F.col("l_orderkey") % 3 == load)
        seen = part.select(F.col("l_partkey").alias("instrument"), F.to_date(F.trunc("l_shipdate", "month")).alias("date"))
        U.seen_bitmaps(K.within_span(seen, listed, "instrument"), "instrument").write.mode("append").parquet(path)
    merged = U.merge_bitmaps(spark.read.schema("date date, bucket bigint, bits binary").parquet(path))
    expected = K.expected_per_period(listed, "instrument", step="INTERVAL 1 MONTH")
    return _rounded(U.coverage_by_bitmap(expected, merged), "coverage")


@query(
    sql(
        """
SELECT metric_name, shard, date_trunc('day', timestamp) AS bucket, count(*) AS n,
       min(metric_value) AS min_value, max(metric_value) AS max_value,
       round(avg(metric_value), 6) AS avg_value, true AS p50_is_near, true AS p95_is_near
FROM metric_rows GROUP BY ALL""",
        "metric_rows",
    )
)
def rollup_of_rollups(spark: SparkSession, folder: str) -> DataFrame:
    """Days out of stored hours; the rank of a percentile is within three times the stated error, one row in a group at least."""
    by, path = ["metric_name", "shard"], new_folder(spark, "hours")
    rows = V.metric_rows(spark, folder).withColumn("shard", F.col("labels")["shard"])
    U.rollup(rows, by, "metric_value").write.parquet(path)
    days = U.with_percentiles(U.merge_rollups(spark.read.parquet(path), by, "1 day"), {"p50": 0.5, "p95": 0.95})
    days = days.drop(U.SKETCH, "sum_value")
    of_day = rows.select(*by, "metric_value", F.window("timestamp", "1 day")["start"].alias("bucket"))
    for name, share in (("p50", 0.5), ("p95", 0.95)):
        off = U.rank_off(of_day, days, [*by, "bucket"], "metric_value", name, share)
        near = F.col("rank_off") <= F.greatest(F.lit(3 * U.RANK_ERROR), 1 / F.col("n"))
        days = days.join(off, [*by, "bucket"]).withColumn(f"{name}_is_near", near).drop("rank_off")
    return _rounded(days.drop("p50", "p95"), "avg_value").withColumn("bucket", plain(F.col("bucket")))


_VOLUME_SQL = sql(
    "SELECT symbol, date, CAST(sum(quantity) AS BIGINT) AS volume FROM daily GROUP BY ALL", "daily"
)


@query(_VOLUME_SQL)
def volume_daily(spark: SparkSession, folder: str) -> DataFrame:
    return K.volume(V.daily(spark, folder), "symbol", "date", "quantity")


@query(
    sql(
        """
WITH snapshots AS (
  SELECT symbol, date, sum(quantity) OVER (
    PARTITION BY symbol, date
    ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, price, quantity
    ROWS UNBOUNDED PRECEDING) AS so_far
  FROM daily)
SELECT symbol, date, CAST(max(so_far) AS BIGINT) AS volume FROM snapshots GROUP BY ALL""",
        "daily",
    )
)
def volume_cumulative(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that carry the day's total so far."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price", "quantity"]
    trades = ordered(V.daily(spark, folder), ["symbol", "date"], order)
    snapshots = trades.running({"so_far": F.col("quantity")}).result()
    return K.volume(snapshots, "symbol", "date", "so_far", cumulative=True)


@query(
    sql(
        """
SELECT symbol, CAST(ts + INTERVAL 330 MINUTE AS DATE) AS date,
       arg_min(price, row(ts, trade_id)) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, row(ts, trade_id)) AS close, CAST(sum(qty) AS BIGINT) AS volume,
       CAST(sum(price * qty) AS DECIMAL(28,4)) AS value, count(*) AS trades
FROM ticks GROUP BY ALL""",
        "ticks",
    )
)
def ohlcv_daily(spark: SparkSession, folder: str) -> DataFrame:
    days = K.ohlcv_daily(V.ticks(spark, folder))
    return days.withColumn("value", F.col("value").cast("decimal(28,4)"))


@query(
    sql(
        """
SELECT log_level, component, date_trunc('hour', timestamp) AS hour, count(*) AS n
FROM log_rows GROUP BY ALL""",
        "log_rows",
    )
)
def log_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = M.log_counts(V.log_rows(spark, folder))
    return counts.withColumn("hour", plain(F.col("hour")))


@query(
    sql(
        f"""
SELECT component, max(timestamp) AS last_heartbeat,
       CASE WHEN epoch_us(TIMESTAMP '{_NOW}') - epoch_us(max(timestamp)) > 1800000000
            THEN 'down' ELSE 'up' END AS status
FROM log_rows GROUP BY component""",
        "log_rows",
    )
)
def component_health(spark: SparkSession, folder: str) -> DataFrame:
    health = M.component_health(V.log_rows(spark, folder), _NOW, interval_s=1800)
    return health.withColumn("last_heartbeat", plain(F.col("last_heartbeat")))


@query(
    sql(
        """
SELECT m.metric_name, metric_value, timestamp, comparator, threshold, severity
FROM metric_rows m
JOIN (VALUES ('value_error', '>', 50.0::DOUBLE, 'critical'),
             ('value_error', '>=', 20.0::DOUBLE, 'warning'),
             ('value_click', '<', 1.0::DOUBLE, 'warning'),
             ('value_view', '<=', 0.5::DOUBLE, 'info'),
             ('value_signup', '=', 10.0::DOUBLE, 'info'),
             ('value_none', '!=', 0.0::DOUBLE, 'info'))
     AS r(metric_name, comparator, threshold, severity) ON m.metric_name = r.metric_name
WHERE CASE comparator WHEN '>' THEN metric_value > threshold
        WHEN '>=' THEN metric_value >= threshold WHEN '<' THEN metric_value < threshold
        WHEN '<=' THEN metric_value <= threshold WHEN '=' THEN metric_value = threshold
        ELSE metric_value <> threshold END""",
        "metric_rows",
    )
)
def alerts_fired(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(
        [
            ("value_error", ">", 50.0, "critical"),
            ("value_error", ">=", 20.0, "warning"),
            ("value_click", "<", 1.0, "warning"),
            ("value_view", "<=", 0.5, "info"),
            ("value_signup", "=", 10.0, "info"),
            ("value_none", "!=", 0.0, "info"),
        ],
        "metric_name string, comparator string, threshold double, severity string",
    )
    fired = M.alerts_fired(V.metric_rows(spark, folder).drop("labels"), rules)
    return fired.withColumn("timestamp", plain(F.col("timestamp")))
