"""Named queries over the test tables, each with the SQL its result is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function under its name. Results are compared as UTC times."""

    def add(run: Run) -> Run:
        def in_utc(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, folder)

        if run.__name__ in QUERIES:
            raise ValueError(f"query {run.__name__} exists")
        QUERIES[run.__name__] = in_utc
        if sql:
            ORACLES[run.__name__] = sql
        return run

    return add
