"""Raw records to typed rows, and the small projections around log and metric rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.timing import exchange_day, parse_instant
from tickloom.schemas import CORRUPT, DERIVATIVES, EQUITY, INDICES, TABLES, TableSpec

TYPE_ERRORS = "type_errors"

# Names the feeds use where they differ from the table's.
EQUITY_NAMES = {
    "prev_close": "prevClose",
    "total_traded_quantity": "tottrdqty",
    "total_traded_value": "tottrdval",
    "total_trades": "totaltrades",
}
DERIVATIVES_NAMES = {
    "expiry_date": "expiryDate",
    "instrument_type": "instrumentType",
    "strike_price": "strikePrice",
    "option_type": "optionType",
    "prev_close": "prevClose",
    "open_interest": "openInterest",
    "change_in_oi": "changeInOI",
}

INDICES_NAMES = {
    "index_name": "indexName",
    "points_change": "pointsChange",
    "percent_change": "percentChange",
    "div_yield": "divYield",
}

# Log levels, least severe first.
LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")


def try_type(raw: Column, to: T.DataType) -> Column:
    """The value in the declared type, NULL when it cannot be; times are cut to milliseconds."""
    if isinstance(to, T.TimestampType):
        return parse_instant(raw.cast("string"))
    return raw.try_cast(to)


def apply_types(df: DataFrame, table: str) -> DataFrame:
    """Declared types for the columns of a table that are present.

    Never fails: a value that does not fit becomes NULL and its column is named in
    `type_errors`.
    """
    spec = TABLES[table]
    present = [f for f in spec.schema.fields if f.name in df.columns]
    typed = {f.name: try_type(F.col(f.name), f.dataType) for f in present}
    lost = [F.when(F.col(n).isNotNull() & c.isNull(), F.lit(n)) for n, c in typed.items()]
    others = [c for c in df.columns if c not in typed]
    return df.select(
        *others,
        *[c.alias(n) for n, c in typed.items()],
        F.array_compact(F.array(*lost)).alias(TYPE_ERRORS),
    )


def _normalize(df: DataFrame, spec: TableSpec, names: dict[str, str]) -> DataFrame:
    def source(column: str) -> Column:
        raw = names.get(column, column)
        return F.col(raw) if raw in df.columns else F.lit(None)

    from_feed = [c for c in spec.columns if c not in ("date", "created_at")]
    unread = [CORRUPT] if CORRUPT in df.columns else []
    renamed = df.select(*[source(c).alias(c) for c in from_feed], *unread)
    typed = apply_types(renamed, spec.name)
    if unread:
        broken = F.when(F.col(CORRUPT).isNotNull(), F.lit(CORRUPT))
        typed = typed.withColumn(
            TYPE_ERRORS, F.array_compact(F.concat(TYPE_ERRORS, F.array(broken)))
        )
    day = exchange_day(F.col("timestamp"))
    return typed.withColumn("date", day).select(
        *[c for c in spec.columns if c != "created_at"], TYPE_ERRORS, *unread
    )


def normalize_equity(df: DataFrame) -> DataFrame:
    """Feed records to equity rows; the trading day comes from the time stamp."""
    return _normalize(df, EQUITY, EQUITY_NAMES)


def normalize_derivatives(df: DataFrame) -> DataFrame:
    """Feed records to derivatives rows; the trading day comes from the time stamp."""
    return _normalize(df, DERIVATIVES, DERIVATIVES_NAMES)


def normalize_indices(df: DataFrame) -> DataFrame:
    """Feed records to index rows; the trading day comes from the time stamp."""
    return _normalize(df, INDICES, INDICES_NAMES)


NORMALIZE = {
    "equity": normalize_equity,
    "derivatives": normalize_derivatives,
    "indices": normalize_indices,
}


def parse_event_time(df: DataFrame, text: str) -> DataFrame:
    """`timestamp` in milliseconds and the `date` it has at the exchange, from ISO text."""
    instant = parse_instant(F.col(text))
    return df.withColumns({"timestamp": instant, "date": exchange_day(instant)})


def canonical_keys(df: DataFrame) -> DataFrame:
    """Trim and upper-case key columns; an empty option type and a zero strike mean none."""
    wanted = [
        c for c in ("symbol", "series", "instrument_type", "option_type") if c in df.columns
    ]
    clean = {c: F.upper(F.trim(c)) for c in wanted}
    if "option_type" in clean:
        clean["option_type"] = F.nullif(clean["option_type"], F.lit(""))
    if "strike_price" in df.columns:
        clean["strike_price"] = F.nullif(F.col("strike_price"), F.lit(0).cast("decimal(18,4)"))
    return df.withColumns(clean)


def level_rank(level: Column) -> Column:
    """Position of a level in LEVELS, any case; NULL for an unknown one."""
    place = F.array_position(F.array(*[F.lit(x) for x in LEVELS]), F.upper(F.trim(level)))
    return F.nullif(place, F.lit(0))


def logs_at_or_above(df: DataFrame, level: str, column: str = "log_level") -> DataFrame:
    """Rows at least as severe as `level`."""
    if level.strip().upper() not in LEVELS:
        raise ValueError(f"unknown level {level!r}; one of {', '.join(LEVELS)}")
    return df.filter(level_rank(F.col(column)) >= LEVELS.index(level.strip().upper()) + 1)


def merge_extra(computed: Column, extra: Column) -> Column:
    """Union of two maps in which `extra` wins on equal keys; a NULL `extra` changes nothing."""
    kept = F.map_filter(computed, lambda k, _: ~F.coalesce(F.map_contains_key(extra, k), F.lit(False)))
    return F.when(extra.isNull(), computed).otherwise(F.map_concat(kept, extra))


def attach_context(
    df: DataFrame, service: str, version: str, environment: str, component: str
) -> DataFrame:
    """The fixed fields every log row carries."""
    fixed = {
        "service": service,
        "version": version,
        "environment": environment,
        "component": component,
    }
    return df.withColumns({name: F.lit(value) for name, value in fixed.items()})
