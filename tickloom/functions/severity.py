"""Severity and message of batches and requests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits that decide the severity.
ERROR_RATE = 0.95
WARNING_RATE = 0.99
SLOW_RECORDS_PER_SECOND = 100
SLOW_REQUEST_MS = 1000
SERVER_ERROR = 500
CLIENT_ERROR = 400

# The messages.
BATCH_MESSAGE = "Batch %s: %d records processed in %.3fs (%.2f%% success rate)"
REQUEST_MESSAGE = "%s %s - %d (%.2fms)"


def batch_severity(records: Column, seconds: Column, success_rate: Column) -> Column:
    """By success rate first, then by speed; a batch without a duration counts as slow."""
    slow = (seconds <= 0) | (F.try_divide(records, seconds) < SLOW_RECORDS_PER_SECOND)
    return (
        F.when(success_rate < ERROR_RATE, "error")
        .when(success_rate < WARNING_RATE, "warning")
        .when(slow, "warning")
        .otherwise("info")
    )


def batch_message(operation: Column, records: Column, seconds: Column, rate: Column) -> Column:
    return F.format_string(
        BATCH_MESSAGE,
        operation,
        records,
        seconds.cast("double"),
        rate.cast("double") * 100,
    )


def request_severity(status: Column, milliseconds: Column) -> Column:
    """By status first, then by time."""
    return (
        F.when(status >= SERVER_ERROR, "error")
        .when(status >= CLIENT_ERROR, "warning")
        .when(milliseconds > SLOW_REQUEST_MS, "warning")
        .otherwise("info")
    )


def request_message(method: Column, path: Column, status: Column, milliseconds: Column) -> Column:
    return F.format_string(
        REQUEST_MESSAGE, method, path, status, milliseconds.cast("double")
    )
