"""Market figures: day summaries and bars, volume, latest rows, coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.timing import exchange_day


def order_key(df: DataFrame, order: Sequence[str]) -> Column:
    """One value that sorts as the order columns do, NULLs first.

    An instant and a whole number, the usual order, become one decimal: aggregates by a struct
    sort all their input, those by a decimal hash it. Microseconds take 18 digits and any long,
    moved above 0, takes 20.
    """
    kinds = [df.schema[c].dataType for c in order]
    if len(order) == 1:
        return F.col(order[0])
    if len(order) != 2 or not (isinstance(kinds[0], T.TimestampType) and isinstance(kinds[1], T.IntegralType)):
        return F.struct(*order)
    wide = "decimal(38,0)"
    moved = F.col(order[1]).cast("decimal(20,0)") + F.lit("9223372036854775809").cast("decimal(20,0)")
    micros = F.coalesce(F.unix_micros(order[0]), F.lit(-(10**17))).cast("decimal(18,0)")
    scaled = (micros * F.lit("100000000000000000000").cast("decimal(21,0)")).cast(wide)
    return (scaled + F.coalesce(moved, F.lit(0)).cast(wide)).cast(wide)


def ohlcv(
    df: DataFrame,
    by: Sequence[str | Column],
    price: str = "price",
    quantity: str = "qty",
    order: Sequence[str] = ("ts", "trade_id"),
) -> DataFrame:
    """Open, high, low, close, volume, value and trades per group.

    `order` ends in an id, so that open and close are well defined among equal times.
    """
    when = order_key(df, order)
    return df.groupBy(*by).agg(
        F.min_by(price, when).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, when).alias("close"),
        F.sum(quantity).alias("volume"),
        F.sum(F.col(price) * F.col(quantity)).alias("value"),
        F.count(F.lit(1)).alias("trades"),
    )


def ohlcv_daily(df: DataFrame, key: str = "symbol", timestamp: str = "ts", **columns) -> DataFrame:
    """Day summary per symbol, in exchange days."""
    return ohlcv(df, [key, exchange_day(F.col(timestamp)).alias("date")], **columns)


def bars(
    df: DataFrame, width: str, key: str = "symbol", timestamp: str = "ts", **columns
) -> DataFrame:
    """Summary per symbol and time bucket.

    Grouped by the window itself, which keeps a stream's watermark, and named by its start.
    """
    grouped = ohlcv(df, [key, F.window(timestamp, width).alias("_window")], **columns)
    return grouped.select(
        key, F.col("_window.start").alias("bar"), *[c for c in grouped.columns[2:]]
    )


def volume(
    df: DataFrame, key: str, day: str, quantity: str, cumulative: bool = False
) -> DataFrame:
    """Traded quantity per symbol and day.

    `cumulative` is for feeds whose rows carry the day's total so far: summing those would
    count the same trades many times, so the largest one counts.
    """
    figure = F.max(quantity) if cumulative else F.sum(quantity)
    return df.groupBy(key, day).agg(figure.alias("volume"))


def latest(
    df: DataFrame, keys: Sequence[str], timestamp: str, tiebreak: Sequence[str]
) -> DataFrame:
    """The newest row of every key."""
    order = F.struct(timestamp, *tiebreak)
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_newest"))
    return newest.select(
        *[F.col(c) if c in keys else F.col(f"_newest.{c}").alias(c) for c in df.columns]
    )


def expected_instruments(
    listed: DataFrame, key: str, first: str, last: str, step: str = "INTERVAL 1 DAY", since: str | None = None, until: str | None = None
) -> DataFrame:
    """One row per instrument and period between its first and last listed `date`.

    That grows with instruments times periods, so ask for a range: `since` and `until` are periods
    of the calendar that bound it, and no more than those are made.
    """
    begin = F.greatest(F.col(first), F.lit(since).cast("date")) if since else F.col(first)
    end = F.least(F.col(last), F.lit(until).cast("date")) if until else F.col(last)
    periods = F.when(begin <= end, F.sequence(begin, end, F.expr(step)))
    return listed.select(key, F.explode(periods).alias("date"))


def coverage(expected: DataFrame, seen: DataFrame, key: str, day: str = "date") -> DataFrame:
    """Observed and expected instruments per day, and their ratio.

    `seen` may hold any number of rows per instrument. Both sides shrink to one row per
    instrument and day in the same aggregate, so there is nothing to join.
    """
    wanted = expected.select(day, key, F.lit(True).alias("_wanted"), F.lit(False).alias("_seen"))
    there = seen.select(day, key, F.lit(False).alias("_wanted"), F.lit(True).alias("_seen"))
    pairs = wanted.unionByName(there).groupBy(day, key).agg(
        F.max("_wanted").alias("_wanted"), F.max("_seen").alias("_seen")
    )
    observed = F.count_if(F.col("_wanted") & F.col("_seen"))
    total = F.count_if("_wanted")
    counts = pairs.groupBy(day).agg(observed.alias("observed"), total.alias("expected"))
    return counts.filter(F.col("expected") > 0).withColumn(
        "coverage", F.col("observed") / F.col("expected")
    )


def approximate_coverage(
    expected: DataFrame, seen: DataFrame, key: str, day: str = "date"
) -> DataFrame:
    """As `coverage`, from distinct-count sketches; instruments not expected count as well."""
    observed = seen.groupBy(day).agg(F.approx_count_distinct(key).alias("observed"))
    wanted = expected.groupBy(day).agg(F.approx_count_distinct(key).alias("expected"))
    ratio = F.col("observed") / F.col("expected")
    return wanted.join(observed, day, "left").withColumn("coverage", ratio)


def missing_instruments(
    expected: DataFrame, seen: DataFrame, key: str, day: str = "date"
) -> DataFrame:
    """Expected instruments that were not seen on a day."""
    return expected.join(seen.select(day, key).distinct(), [day, key], "left_anti")


def within_span(seen: DataFrame, listed: DataFrame, key: str, day: str = "date") -> DataFrame:
    """Rows of `seen` inside their instrument's listed span, copies and all."""
    spans = listed.groupBy(key).agg(F.min("first").alias("_first"), F.max("last").alias("_last"))
    return seen.join(spans, key).where(F.col(day).between(F.col("_first"), F.col("_last"))).drop("_first", "_last")


def _within(seen: DataFrame, listed: DataFrame, key: str, day: str) -> DataFrame:
    """Distinct (instrument, period) of `seen` inside the instrument's listed span, with the span."""
    pairs = seen.select(F.col(key).alias("_key"), day).distinct()
    spans = listed.groupBy(key).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return pairs.join(spans, pairs["_key"] == spans[key]).where(F.col(day).between(F.col("first"), F.col("last"))).drop("_key")


def coverage_by_span(
    listed: DataFrame, seen: DataFrame, key: str, day: str = "date", step: str = "INTERVAL 1 DAY"
) -> DataFrame:
    """As `coverage`, from spans: `listed` has one row per instrument with its `first` and `last` period.

    What is expected is counted by entries and exits, added up over the calendar, so no row is made
    for an instrument and period. Several rows of an instrument are one span.
    """
    there = _within(seen, listed, key, day).groupBy(day).agg(F.count(F.lit(1)).alias("observed"))
    return (
        expected_per_period(listed, key, day, step)
        .join(there, day, "left")
        .select(day, F.coalesce("observed", F.lit(0)).alias("observed"), "expected")
        .withColumn("coverage", F.col("observed") / F.col("expected"))
    )


def expected_per_period(listed: DataFrame, key: str, day: str = "date", step: str = "INTERVAL 1 DAY") -> DataFrame:
    """How many instruments are listed in each period of the calendar that has any."""
    spans = listed.groupBy(key).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    after = (F.col("last") + F.expr(step)).cast("date")
    moves = spans.select(F.col("first").cast("date").alias(day), F.lit(1).alias("n")).union(
        spans.select(after, F.lit(-1))
    )
    moves = moves.groupBy(day).agg(F.sum("n").alias("n"))
    border = moves.agg(F.min(day).alias("a"), F.max(day).alias("b")).where("a IS NOT NULL")
    calendar = border.select(F.explode(F.sequence("a", "b", F.expr(step))).alias(day))
    # one row per period of the calendar
    so_far = Window.orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = calendar.join(moves, day, "left").select(day, F.sum("n").over(so_far).alias("expected"))
    return counts.where("expected > 0")


def missing_ranges(
    listed: DataFrame, seen: DataFrame, key: str, day: str = "date", step: str = "INTERVAL 1 DAY"
) -> DataFrame:
    """Gaps of each instrument inside its listed span: the first and the last missing period.

    Gaps lie between neighbouring seen periods, so the output grows with the gaps, not their length.
    """
    one = F.expr(step)
    spans = listed.groupBy(key).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    borders = spans.select(key, F.explode(F.array((F.col("first") - one).cast("date"), (F.col("last") + one).cast("date"))).alias(day))
    known = _within(seen, listed, key, day).select(key, F.col(day).cast("date").alias(day)).unionByName(borders)
    after = F.lead(day).over(Window.partitionBy(key).orderBy(day))
    found = known.select(key, (F.col(day) + one).cast("date").alias("missing_from"), (after - one).cast("date").alias("missing_to"))
    return found.where("missing_from <= missing_to")
