"""Declared layout of the five tables: types, keys, month source, retention.

Nothing in the library infers a schema. Unsigned integers are longs whose range
is checked by validation, since Spark has no unsigned type.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

EXCHANGE_ZONE = "Asia/Kolkata"

UINT32_MAX = 2**32 - 1

CORRUPT = "_corrupt"
"""Text of a record that could not be read."""


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "price": T.DecimalType(18, 4),
    "money": T.DecimalType(18, 2),
    "labels": T.MapType(T.StringType(), T.StringType()),
}


def _struct(columns: str) -> T.StructType:
    """Schema from "name type, name type"; needs no session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class TableSpec:
    """What the writer, the reader and the retention job need to know."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    """Identifies one series: an instrument, an index, a contract, a metric."""
    layout: tuple[str, ...]
    """Order of rows inside a month."""
    month_of: str
    """Column whose month is the partition."""
    keep: str
    """Retention as an interval literal."""
    day_default: tuple[str, ...] = ()
    """Columns filled with the load day when absent."""
    now_default: tuple[str, ...] = ()
    """Columns filled with the load time when absent."""
    unsigned: dict[str, int | None] = field(default_factory=dict)
    """Columns that must be >= 0, with their upper bound where there is one."""

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def type_of(self, column: str) -> T.DataType:
        return self.schema[column].dataType


# Columns, types, keys, layout and retention of the five tables.
EQUITY = TableSpec(
    name="equity",
    schema=_struct(
        """symbol string, series string, date date, timestamp timestamp,
        open price, high price, low price, close price,
        last price, prev_close price,
        total_traded_quantity bigint, total_traded_value money, total_trades bigint,
        isin string, created_at timestamp"""
    ),
    key=("symbol",),
    layout=("symbol", "timestamp"),
    month_of="date",
    keep="INTERVAL 5 YEARS",
    day_default=("date",),
    now_default=("created_at",),
    unsigned={"total_traded_quantity": None, "total_trades": UINT32_MAX},
)

# The layout order does not identify a contract: strike and option type are missing from it.
DERIVATIVES = TableSpec(
    name="derivatives",
    schema=_struct(
        """symbol string, expiry_date date, instrument_type string, strike_price price,
        option_type string, date date, timestamp timestamp,
        open price, high price, low price, close price,
        last price, prev_close price,
        volume bigint, value money, open_interest bigint, change_in_oi bigint,
        created_at timestamp"""
    ),
    key=("symbol", "expiry_date", "instrument_type", "strike_price", "option_type"),
    layout=("symbol", "expiry_date", "instrument_type", "timestamp"),
    month_of="date",
    keep="INTERVAL 5 YEARS",
    day_default=("date",),
    now_default=("created_at",),
    unsigned={"volume": None, "open_interest": None},
)

INDICES = TableSpec(
    name="indices",
    schema=_struct(
        """index_name string, date date, timestamp timestamp,
        open price, high price, low price, close price,
        points_change price, percent_change price,
        volume bigint, turnover money,
        pe price, pb price, div_yield price, created_at timestamp"""
    ),
    key=("index_name",),
    layout=("index_name", "timestamp"),
    month_of="date",
    keep="INTERVAL 5 YEARS",
    day_default=("date",),
    now_default=("created_at",),
    unsigned={"volume": None},
)

SYSTEM_METRICS = TableSpec(
    name="system_metrics",
    schema=_struct(
        """metric_name string, metric_value double, labels labels,
        timestamp timestamp"""
    ),
    key=("metric_name",),
    layout=("metric_name", "timestamp"),
    month_of="timestamp",
    keep="INTERVAL 90 DAYS",
    now_default=("timestamp",),
)

PROCESSING_LOGS = TableSpec(
    name="processing_logs",
    schema=_struct(
        """log_level string, component string, message string, extra labels,
        timestamp timestamp"""
    ),
    key=("component",),
    layout=("timestamp",),
    month_of="timestamp",
    keep="INTERVAL 30 DAYS",
    now_default=("timestamp",),
)

TABLES = {
    spec.name: spec for spec in (EQUITY, DERIVATIVES, INDICES, SYSTEM_METRICS, PROCESSING_LOGS)
}

# Names of raw records as the feeds deliver them. Everything is text here: a reader
# that is told of a number makes NULL of what is none, and the reason would be lost.
RAW_EQUITY = _struct(
    """symbol string, series string, open string, high string, low string, close string,
    last string, prevClose string, tottrdqty string, tottrdval string, timestamp string,
    totaltrades string, isin string"""
)

RAW_DERIVATIVES = _struct(
    """symbol string, expiryDate string, instrumentType string, strikePrice string,
    optionType string, open string, high string, low string, close string, last string,
    prevClose string, volume string, value string, openInterest string, changeInOI string,
    timestamp string"""
)

# Ours: the index feed has a table and a cadence, but no record of it is shown anywhere.
RAW_INDICES = _struct(
    """indexName string, open string, high string, low string, close string,
    pointsChange string, percentChange string, volume string, turnover string,
    pe string, pb string, divYield string, timestamp string"""
)
