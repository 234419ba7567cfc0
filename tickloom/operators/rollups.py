"""Rollups that add up: figures per hour are kept and merged to days, weeks or over loads without the rows.

Counts, sums, minima and maxima merge as they are. Percentiles do not, so a rollup holds a KLL sketch
of its values, and sketches merge to one of all their values at the same error. Seen instruments are
bits of a bitmap per day, which merge by OR, so each load is read once and copies count once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch. The rank of a percentile it gives is off by no more than RANK_ERROR in 99 of 100 cases,
#: by calculation for sketches of this size, whether of one hour or merged from many.
SKETCH_K = 800
RANK_ERROR = 0.0035
SKETCH = "sketch"


def rollup(df: DataFrame, by: Sequence[str], value: str, timestamp: str = "timestamp", width: str = "1 hour", k: int = SKETCH_K) -> DataFrame:
    """Per group and bucket of time: n, min_value, max_value, sum_value and a sketch of the values.

    NULL values are left out; a bucket has a row once it has one. Partial sketches are made before the
    shuffle, so a group's rows never meet in one task.
    """
    x = F.col(value).cast("double")
    rows = df.where(x.isNotNull()).select(*by, F.window(timestamp, width)["start"].alias("bucket"), x.alias("_x"))
    return rows.groupBy(*by, "bucket").agg(
        F.count("_x").alias("n"), F.min("_x").alias("min_value"), F.max("_x").alias("max_value"), F.sum("_x").alias("sum_value"), F.kll_sketch_agg_double("_x", k).alias(SKETCH)
    )


def merge_rollups(parts: DataFrame, by: Sequence[str], width: str, k: int = SKETCH_K) -> DataFrame:
    """Rollups of wider buckets out of those of narrower ones; several rows of one bucket are parts of it."""
    placed = parts.withColumn("bucket", F.window("bucket", width)["start"])
    return placed.groupBy(*by, "bucket").agg(
        F.sum("n").alias("n"), F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"), F.sum("sum_value").alias("sum_value"), F.kll_merge_agg_double(SKETCH, k).alias(SKETCH)
    )


def with_percentiles(rolled: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Add the mean and, under each name, the value of about that rank: one of the values that were seen."""
    picks = {name: F.kll_sketch_get_quantile_double(SKETCH, F.lit(float(share))) for name, share in shares.items()}
    return rolled.withColumns({"avg_value": F.col("sum_value") / F.col("n"), **picks})


def rank_off(rows: DataFrame, picked: DataFrame, by: Sequence[str], value: str, pick: str, share: float) -> DataFrame:
    """How far the rank of `pick` in a group's rows is from `share`: 0 while it lies among rows equal to it."""
    own = picked.select(*[F.col(c).alias(f"_{c}") for c in by], F.col(pick).alias("_pick"))
    both = rows.join(own, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]))
    below, upto = F.avg((F.col(value) < F.col("_pick")).cast("double")), F.avg((F.col(value) <= F.col("_pick")).cast("double"))
    off = F.greatest(below - share, F.lit(share) - upto, F.lit(0.0))
    return both.where(F.col(value).isNotNull()).groupBy(*by).agg(off.alias("rank_off"))


# Seen instruments as bits -----------------------------------------------------------------


def seen_bitmaps(seen: DataFrame, number: str, day: str = "date") -> DataFrame:
    """Per day and bucket of 32,768 numbers: a bitmap of the instruments seen, `number` being a whole number from 1.

    Rows without a number or day are left out. Bits are set before the shuffle, so copies, however
    many, shrink to bitmaps of 4 kB where they are read.
    """
    known = seen.where(F.col(number).isNotNull() & F.col(day).isNotNull())
    placed = known.select(F.col(day), F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("_bit"))
    return placed.groupBy(day, "bucket").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def merge_bitmaps(parts: DataFrame, day: str = "date") -> DataFrame:
    """One bitmap per day and bucket out of those of several loads."""
    return parts.groupBy(day, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def seen_per_day(bitmaps: DataFrame, day: str = "date") -> DataFrame:
    """Instruments seen per day, each once."""
    return bitmaps.groupBy(day).agg(F.sum(F.bitmap_count("bits")).alias("observed"))


def coverage_by_bitmap(expected: DataFrame, bitmaps: DataFrame, day: str = "date") -> DataFrame:
    """Observed and expected instruments per day of `expected` (day, expected), and their ratio.

    Bitmaps hold instruments inside their listed spans, as `within_span` leaves them.
    """
    found = expected.join(seen_per_day(bitmaps, day), day, "left")
    observed: Column = F.coalesce("observed", F.lit(0))
    return found.select(day, observed.alias("observed"), "expected", (observed / F.col("expected")).alias("coverage"))
