"""All named queries; importing the modules registers them."""

from __future__ import annotations

from tickloom.plans import (  # noqa: F401
    clean_queries,
    indicator_queries,
    monitor_queries,
    storage_queries,
    stream_queries,
)
from tickloom.plans.registry import ORACLES, QUERIES, Run


def queries() -> dict[str, Run]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
