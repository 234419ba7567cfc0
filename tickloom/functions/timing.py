"""Exchange time: instants are stored, days and months are those of the exchange."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.schemas import EXCHANGE_ZONE


def exchange_clock(instant: Column) -> Column:
    """Wall-clock time at the exchange, whatever zone the session is in."""
    return F.convert_timezone(
        F.current_timezone(), F.lit(EXCHANGE_ZONE), instant.cast("timestamp_ntz")
    )


def exchange_day(instant: Column) -> Column:
    return F.to_date(exchange_clock(instant))


def exchange_midnight(day: Column) -> Column:
    """The instant at which a day begins at the exchange."""
    clock = F.convert_timezone(
        F.lit(EXCHANGE_ZONE), F.current_timezone(), day.cast("timestamp_ntz")
    )
    return clock.cast("timestamp")


def month_number(day_or_clock: Column) -> Column:
    """Year and month as one integer, such as 202309."""
    return F.year(day_or_clock) * 100 + F.month(day_or_clock)


def to_millis(instant: Column) -> Column:
    return F.date_trunc("MILLISECOND", instant)


def to_seconds(instant: Column) -> Column:
    return F.date_trunc("SECOND", instant)


def parse_instant(text: Column) -> Column:
    """ISO time with an offset, cut to milliseconds; NULL when unreadable."""
    return to_millis(F.try_to_timestamp(text))


def plain(instant: Column) -> Column:
    """Zone-less timestamp in the session zone, for comparing with systems that have no zones."""
    return instant.cast("timestamp_ntz")
