"""Batch and request metrics on hand-computed cases."""

import pytest
from pyspark.sql import functions as F

from tickloom.operators import monitor as M

# Cases and what must come out.
BATCHES = [
    # operation, records, seconds, rate, extra, records/s, severity
    ("equity_data_ingestion", 1000, 2.5, 1.0, {"batch_id": "batch-123"}, 400.0, "info"),
    ("derivatives_processing", 500, 1.0, 0.96, {"errors": "20"}, 500.0, "warning"),
    ("data_validation", 100, 0.5, 0.90, None, 200.0, "error"),
    ("technical_indicators", 50, 1.0, 1.0, None, 50.0, "warning"),
    ("edge_error", 1000, 1.0, 0.95, None, 1000.0, "warning"),
    ("edge_info", 100, 1.0, 0.99, None, 100.0, "info"),
    ("no_time_bad", 10, 0.0, 0.90, None, 0.0, "error"),
    ("no_time_good", 10, 0.0, 1.0, None, 0.0, "warning"),
    ("overwritten", 1000, 1.0, 1.0, {"success_rate": "n/a"}, 1000.0, "info"),
]


@pytest.fixture(scope="module")
def batches(spark):
    rows = spark.createDataFrame(
        [b[:5] for b in BATCHES],
        "operation string, records_processed bigint, processing_time double, "
        "success_rate double, extra map<string,string>",
    )
    return {r["operation"]: r for r in M.batch_metrics(rows).collect()}


@pytest.mark.parametrize("case", BATCHES, ids=[b[0] for b in BATCHES])
def test_batch(batches, case):
    row = batches[case[0]]
    assert row["records_per_second"] == case[5]
    assert row["severity"] == case[6]
    assert row["operation_type"] == "batch_processing"
    for key, value in (case[4] or {}).items():
        assert row["fields"][key] == value


def test_batch_message(batches):
    assert batches["derivatives_processing"]["message"] == (
        "Batch derivatives_processing: 500 records processed in 1.000s (96.00% success rate)"
    )


def test_severity_uses_unrounded_values(spark):
    rows = spark.createDataFrame(
        [("a", 1000, 1.0, 0.98999), ("b", 1000, 1.0, 0.94999)],
        "operation string, records_processed bigint, processing_time double, success_rate double",
    )
    got = {r["operation"]: (r["success_rate"], r["severity"]) for r in M.batch_metrics(rows).collect()}
    assert got == {"a": (0.99, "warning"), "b": (0.95, "error")}


REQUESTS = [
    ("GET", "/api/data", 200, 150.5, "req-123", {"user_id": "user-456"}, "info"),
    ("POST", "/api/process", 500, 5000.0, "req-456", None, "error"),
    ("GET", "/api/slow", 200, 1500.0, "req-789", None, "warning"),
    ("GET", "/missing", 404, 10.0, "r1", None, "warning"),
    ("GET", "/limit", 200, 1000.0, "r2", None, "info"),
    ("GET", "/odd", 499, 1.0, "r3", None, "warning"),
    ("GET", "/late", 499, 4000.0, "r4", {"path": "other"}, "warning"),
]


def test_requests(spark):
    rows = spark.createDataFrame(
        [r[:6] for r in REQUESTS],
        "method string, path string, status_code int, response_time double, "
        "request_id string, extra map<string,string>",
    )
    got = {r["request_id"]: r for r in M.request_metrics(rows).collect()}
    for case in REQUESTS:
        assert got[case[4]]["severity"] == case[6]
        assert got[case[4]]["request_type"] == "http"
    assert got["req-123"]["message"] == "GET /api/data - 200 (150.50ms)"
    assert got["req-123"]["fields"]["user_id"] == "user-456"
    assert got["r4"]["fields"]["path"] == "other"
    assert got["r4"]["path"] == "/late"


def test_percentiles_equal_the_builtin_in_chunks(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "rare").otherwise("hot").alias("g"),
        ((F.col("id") * 7919) % 1013 / 8).alias("x"),
    )
    shares = {"p50": 0.5, "p99": 0.99}
    want = {
        (r["g"], r["p50"], r["p99"])
        for r in rows.groupBy("g")
        .agg(F.percentile("x", 0.5).alias("p50"), F.percentile("x", 0.99).alias("p99"))
        .collect()
    }
    for size in (10, 100, 10**6):
        got = M.distribution(rows, ["g"], "x", shares, rows_per_task=size).collect()
        assert {(r["g"], round(r["p50"], 9), round(r["p99"], 9)) for r in got} == {
            (g, round(a, 9), round(b, 9)) for g, a, b in want
        }


def test_approximate_rollup_is_close(spark):
    rows = spark.range(1000).select(
        F.lit("m").alias("metric_name"),
        F.col("id").cast("double").alias("metric_value"),
        F.create_map(F.lit("shard"), F.lit("1")).alias("labels"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("timestamp"),
    )
    row = M.metric_rollup(rows, "shard", approximate=True).first()
    assert row["n"] == 1000 and abs(row["p95"] - 949) <= 1


def test_rules_too_many_to_broadcast_join_by_shuffle(spark):
    metrics = spark.createDataFrame([("m", 5.0)], "metric_name string, metric_value double")
    rules = spark.createDataFrame(
        [("m", ">", 4.0, "warning"), ("m", ">", 6.0, "error")],
        "metric_name string, comparator string, threshold double, severity string",
    )
    assert [r["severity"] for r in M.alerts_fired(metrics, rules).collect()] == ["warning"]
    small = M.broadcast_if_small(rules, rows=1)
    assert "broadcast" not in small._jdf.queryExecution().logical().toString().lower()


def test_distribution_with_nulls(spark):
    rows = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("a", 3.0), ("b", None)], "g string, x double"
    )
    sums = {"rows": F.count(F.lit(1))}
    got = {r["g"]: r for r in M.distribution(rows, ["g"], "x", {"p50": 0.5}, sums).collect()}
    assert (got["a"]["n"], got["a"]["rows"], got["a"]["p50"], got["a"]["avg_value"]) == (2, 3, 2.0, 2.0)
    assert (got["b"]["n"], got["b"]["rows"], got["b"]["p50"], got["b"]["avg_value"]) == (0, 1, None, None)
