"""Batch and request metrics, rollups, freshness, health and alerts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import severity as S
from tickloom.operators.normalize import merge_extra
from tickloom.operators.ordered import ROWS_PER_TASK, hot_keys, ordered

HEALTH_SECONDS = 30
BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a side for broadcast once a count shows it has at most `rows` rows.

    A larger side is returned as it is and joins by shuffle.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _text_map(columns: dict[str, Column]) -> Column:
    return F.create_map(
        *[x for name, c in columns.items() for x in (F.lit(name), c.cast("string"))]
    )


def batch_metrics(df: DataFrame) -> DataFrame:
    """Metrics of processed batches.

    Input: operation, records_processed, processing_time (s), success_rate and, if there
    is one, an `extra` map, whose entries win over the computed ones in `fields`.
    Severity is decided on unrounded values.
    """
    n, t, rate = F.col("records_processed"), F.col("processing_time"), F.col("success_rate")
    rounded = {
        "processing_time_s": F.round(t, 3),
        "success_rate": F.round(rate, 4),
        "records_per_second": F.when(t > 0, F.round(F.try_divide(n, t), 2)).otherwise(0.0),
        "operation_type": F.lit("batch_processing"),
    }
    out = {
        **rounded,
        "severity": S.batch_severity(n, t, rate),
        "message": S.batch_message(F.col("operation"), n, t, rate),
    }
    if "extra" in df.columns:
        named = {"operation": F.col("operation"), "records_processed": n, **rounded}
        out["fields"] = merge_extra(_text_map(named), F.col("extra"))
    return df.withColumns(out)


def request_metrics(df: DataFrame) -> DataFrame:
    """Metrics of served requests.

    Input: method, path, status_code, response_time (ms), request_id and, if there is one,
    an `extra` map, as in `batch_metrics`.
    """
    status, ms = F.col("status_code"), F.col("response_time")
    rounded = {"response_time_ms": F.round(ms, 2), "request_type": F.lit("http")}
    out = {
        **rounded,
        "severity": S.request_severity(status, ms),
        "message": S.request_message(F.col("method"), F.col("path"), status, ms),
    }
    if "extra" in df.columns:
        plain = {c: F.col(c) for c in ("request_id", "method", "path", "status_code")}
        out["fields"] = merge_extra(_text_map({**plain, **rounded}), F.col("extra"))
    return df.withColumns(out)


def metrics_to_logs(metrics: DataFrame, component: str, at: str = "timestamp") -> DataFrame:
    """Rows of processing_logs from batch or request metrics with `fields`, one each.

    The level is the severity in capitals, and the fields are the record's extra.
    """
    return metrics.select(
        F.upper("severity").alias("log_level"),
        F.lit(component).alias("component"),
        "message",
        F.col("fields").alias("extra"),
        F.col(at).alias("timestamp"),
    )


def metrics_to_rows(
    metrics: DataFrame, values: Sequence[str], labels: Sequence[str], at: str = "timestamp"
) -> DataFrame:
    """Rows of system_metrics: one for each named figure, labelled by the named columns."""
    named = F.array(
        *[F.struct(F.lit(v).alias("name"), F.col(v).cast("double").alias("value")) for v in values]
    )
    rows = metrics.select(F.explode(named).alias("_m"), _text_map({c: F.col(c) for c in labels}).alias("labels"), F.col(at).alias("timestamp"))
    return rows.select(
        F.col("_m.name").alias("metric_name"), F.col("_m.value").alias("metric_value"), "labels", "timestamp"
    ).filter(F.col("metric_value").isNotNull())


def distribution(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    shares: dict[str, float],
    sums: dict[str, Column] | None = None,
    approximate: bool = False,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Count, min, max, avg and interpolated percentiles of a value per group, of any size.

    `sums` are further counts or sums over the group's rows. Rows with equal values shrink to
    one before the shuffle, and their counts are added up in value order, so no task holds the
    distinct values of a whole group. `approximate` takes sketches instead, in one aggregate.
    """
    sums = sums or {}
    x = F.col(value)
    if approximate:
        return df.groupBy(*by).agg(
            F.count(x).alias("n"),
            F.min(x).alias("min_value"),
            F.max(x).alias("max_value"),
            F.avg(x).alias("avg_value"),
            *[F.percentile_approx(value, s, 10_000).alias(name) for name, s in shares.items()],
            *[c.alias(name) for name, c in sums.items()],
        )
    # A group has no more distinct values than rows, and rows are cheaper to count.
    if rows_per_task and hot_keys(df, by, rows_per_task) is None:
        rows_per_task = None
    counts = df.groupBy(*by, value).agg(
        F.count(x).alias("_n"), *[c.alias(name) for name, c in sums.items()]
    )
    placed = (
        ordered(counts, by, value, rows_per_task)
        .running({"_upto": F.col("_n")}, totals={"_all": F.col("_n")})
        .result()
    )
    picks = []
    for name, share in shares.items():
        place = F.lit(float(share)) * (F.col("_all") - 1)
        for end, position in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            reached = F.when(F.col("_upto") > position, x.cast("double"))
            picks.append(F.min(reached).alias(f"_{name}_{end}"))
        picks.append(F.max(place - F.floor(place)).alias(f"_{name}_part"))

    def between(name: str) -> Column:
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        return (low + (high - low) * F.col(f"_{name}_part")).alias(name)

    return (
        placed.groupBy(*by)
        .agg(
            F.sum("_n").alias("n"),
            F.min(x).alias("min_value"),
            F.max(x).alias("max_value"),
            F.try_divide(F.sum(x * F.col("_n")), F.sum("_n")).alias("avg_value"),
            *[F.sum(name).alias(name) for name in sums],
            *picks,
        )
        .select(
            *by,
            *["n", "min_value", "max_value", "avg_value"],
            *[between(name) for name in shares],
            *sums,
        )
    )


def metric_rollup(
    df: DataFrame,
    label: str,
    width: str = "1 hour",
    approximate: bool = False,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Count, min, max, avg and p95 of system metrics per name, one label and time bucket."""
    rows = df.select(
        "metric_name",
        "metric_value",
        F.col("labels").getItem(label).alias(label),
        F.window("timestamp", width)["start"].alias("bucket"),
    )
    by = ["metric_name", label, "bucket"]
    return distribution(
        rows, by, "metric_value", {"p95": 0.95}, None, approximate, rows_per_task
    )


def error_rate(
    df: DataFrame,
    width: str = "1 hour",
    approximate: bool = False,
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Share of failed requests, and median, p95 and p99 of the response time, per bucket."""
    rows = df.select(
        F.window("timestamp", width)["start"].alias("bucket"), "status_code", "response_time"
    )
    shares = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    sums = {
        "requests": F.count(F.lit(1)),
        "_failed": F.count_if(F.col("status_code") >= S.SERVER_ERROR),
    }
    found = distribution(
        rows, ["bucket"], "response_time", shares, sums, approximate, rows_per_task
    )
    rate = (F.col("_failed") / F.col("requests")).alias("error_rate")
    return found.select("bucket", "requests", rate, *shares)


def records_per_hour(df: DataFrame, feed: str, timestamp: str = "timestamp") -> DataFrame:
    return df.groupBy(feed, F.date_trunc("HOUR", timestamp).alias("hour")).agg(
        F.count(F.lit(1)).alias("records")
    )


def freshness(
    df: DataFrame,
    keys: Sequence[str],
    as_of: str | dt.datetime | Column,
    timestamp: str = "timestamp",
    stale_after_s: int = HEALTH_SECONDS,
) -> DataFrame:
    """Age in seconds of the newest row per key, and whether it is stale."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    age = (
        F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("last_seen"))
    ) / F.lit(1_000_000.0)
    return (
        df.groupBy(*keys)
        .agg(F.max(timestamp).alias("last_seen"))
        .withColumn("age_s", age)
        .withColumn("is_stale", F.col("age_s") > stale_after_s)
    )


def component_health(
    df: DataFrame,
    as_of: str | dt.datetime | Column,
    interval_s: int = HEALTH_SECONDS,
    component: str = "component",
    timestamp: str = "timestamp",
) -> DataFrame:
    """Up or down per component, by the age of its last heartbeat."""
    seen = freshness(df, [component], as_of, timestamp, interval_s)
    return seen.select(
        component,
        F.col("last_seen").alias("last_heartbeat"),
        F.when(F.col("is_stale"), "down").otherwise("up").alias("status"),
    )


def log_counts(df: DataFrame) -> DataFrame:
    """Log rows per level, component and hour."""
    hour = F.date_trunc("HOUR", "timestamp").alias("hour")
    return df.groupBy("log_level", "component", hour).agg(F.count(F.lit(1)).alias("n"))


def alerts_fired(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Metric rows that meet a rule (metric_name, comparator, threshold, severity)."""
    value, limit = F.col("metric_value"), F.col("threshold")
    met = (
        F.when(F.col("comparator") == ">", value > limit)
        .when(F.col("comparator") == ">=", value >= limit)
        .when(F.col("comparator") == "<", value < limit)
        .when(F.col("comparator") == "<=", value <= limit)
        .when(F.col("comparator") == "=", value == limit)
        .when(F.col("comparator") == "!=", value != limit)
    )
    return metrics.join(broadcast_if_small(rules), "metric_name").filter(met)
