"""Validation rules as Columns that are true when a row fails."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

TOLERANCE = "0.01"


def _fails(condition: Column) -> Column:
    """A comparison with NULL is no failure; the required rule reports NULLs."""
    return F.coalesce(condition, F.lit(False))


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def blank(*columns: str) -> Column:
    """A required text column is NULL or has only spaces."""
    return _any([F.col(c).isNull() | (F.trim(c) == "") for c in columns])


def missing(*columns: str) -> Column:
    return _any([F.col(c).isNull() for c in columns])


def uncastable(*pairs: tuple[str, str]) -> Column:
    """(raw, typed): there was a value and it did not fit the type."""
    return _any([F.col(raw).isNotNull() & F.col(typed).isNull() for raw, typed in pairs])


def out_of_range(*columns: str, upper: dict[str, int | None] | None = None) -> Column:
    """Below zero, or above the bound of an unsigned type."""
    low = [F.col(c) < 0 for c in columns]
    high = [F.col(c) > bound for c, bound in (upper or {}).items() if bound is not None]
    return _fails(_any(low + high))


def outside_bounds(*prices: str, low: str = "low", high: str = "high") -> Column:
    """Some price lies outside [low, high], or low is above high."""
    inside = [(F.col(p) < F.col(low)) | (F.col(p) > F.col(high)) for p in prices]
    return _any([_fails(c) for c in inside] + [_fails(F.col(low) > F.col(high))])


def implausible_value(
    value: str, quantity: str, low: str = "low", high: str = "high"
) -> Column:
    """The average price value / quantity is outside [low, high], or there is value without quantity.

    Written without a division, so that decimals stay exact.
    """
    v, q = F.col(value), F.col(quantity)
    traded = (v < F.col(low) * q) | (v > F.col(high) * q)
    return _fails(F.when(q > 0, traded).when(q == 0, v != 0))


def wrong_leg(
    instrument: str = "instrument_type", strike: str = "strike_price", option: str = "option_type"
) -> Column:
    """Futures with a strike or option type, or options that lack one.

    An empty option type and a zero strike count as none.
    """
    kind = F.upper(F.trim(instrument))
    has_strike = F.coalesce(F.col(strike) != 0, F.lit(False))
    above_zero = F.coalesce(F.col(strike) > 0, F.lit(False))
    has_option = F.coalesce(F.trim(option) != "", F.lit(False))
    return _fails(
        F.when(kind.startswith("FUT"), has_strike | has_option).when(
            kind.startswith("OPT"), ~(above_zero & has_option)
        )
    )


def differs(stored: Column, computed: Column, tolerance: str = TOLERANCE) -> Column:
    """A stored figure is further from the computed one than the tolerance."""
    return _fails(F.abs(stored - computed) > F.lit(tolerance).cast("decimal(18,4)"))
