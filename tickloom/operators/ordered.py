"""Ordered series of any size: windows that never put a whole hot key into one task.

`Window.partitionBy(symbol)` sends every row of a symbol to one task. That is right
for most symbols and fatal for one that holds a third of the table. `Ordered` counts the
rows per key first. While every key fits a task it adds nothing to the plan. A larger key
is cut into chunks of consecutive rows, and windows run per chunk:

* frames that look back a bounded number of rows get a copy of the last rows of the
  preceding chunks (`rows_back`), so results equal those of the uncut window;
* running sums get the totals of all preceding chunks (`running`).

Cut points come from a range partitioning of the hot keys' key and order columns, into tasks by the
number of rows, each of which cuts its sorted rows into chunks, however small. Every key with
more than `rows_per_task` rows is cut. Chunks grow once there would be more than MAX_CHUNKS, so there are
about two for each of these and two for each hot key, which is what the driver holds and broadcasts. They are plain values in the plan: a recomputed task
places a row in the same chunk as the first attempt did.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_TASK = 2_000_000
MAX_CHUNKS = 200_000

CHUNK = "_chunk"
CUTS = "_cuts"
HALO = "_halo"


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join that matches NULL keys and keeps the key columns of the left side once."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns]
    )
    condition = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    )
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def hot_keys(
    df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK
) -> tuple[DataFrame, int, int] | None:
    """Keys with more rows than a task should hold, their rows in all, and rows per chunk.

    None if there are no such keys. The key columns are read and counted once. No hot key is
    left out; there are fewer than rows of the table / `rows_per_task`.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot = counts.filter(F.col("_rows") > rows_per_task).collect()
    if not hot:
        return None
    rows = sum(r["_rows"] for r in hot)
    per_chunk = max(rows_per_task, math.ceil(rows / MAX_CHUNKS))
    return df.sparkSession.createDataFrame(hot, counts.schema), rows, per_chunk


@dataclass(frozen=True)
class Ordered:
    """A DataFrame with the key of its series and a total order inside each."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    cut: bool = False
    starts: dict[tuple, list[int]] = field(default_factory=dict)
    """Rows of a cut key before each of its chunks."""

    @property
    def group(self) -> list[str]:
        return [*self.keys, CHUNK] if self.cut else list(self.keys)

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.group).orderBy(*self.order)

    @property
    def later_chunk(self) -> Column:
        """True for rows that have rows of the same key in an earlier chunk."""
        return F.coalesce(F.col(CHUNK) > 0, F.lit(False)) if self.cut else F.lit(False)

    def rows_back(
        self, rows: int, build: Callable[[DataFrame, WindowSpec], DataFrame]
    ) -> "Ordered":
        """Apply `build`, whose windows look back at most `rows` rows of the same key."""
        if not self.cut or rows == 0:
            return replace(self, df=build(self.df, self.window))
        both = self.df.withColumn(HALO, F.lit(False)).unionByName(self._tails(rows))
        built = build(both, self.window).filter(~F.col(HALO)).drop(HALO)
        return replace(self, df=built)

    def _tails(self, rows: int) -> DataFrame:
        """The last `rows` rows before each chunk, marked and placed in it, from as many chunks as it takes."""
        sizes = [b - a for starts in self.starts.values() for a, b in zip(starts, starts[1:])]
        reach = math.ceil(rows / max(1, min(sizes, default=1))) + 1
        keys = [T.StructField(k, self.df.schema[k].dataType) for k in self.keys]
        shape = T.StructType([*keys, T.StructField("_starts", T.ArrayType(T.LongType()))])
        known = self.df.sparkSession.createDataFrame(
            [(*k, starts) for k, starts in self.starts.items()], shape
        )
        numbered = (
            self.df.filter(F.col(CHUNK).isNotNull())
            .withColumn("_nth", F.row_number().over(self.window))
        )
        placed = join_on(numbered, F.broadcast(known), self.keys, "inner")
        at = F.get(F.col("_starts"), F.col(CHUNK)) + F.col("_nth") - 1
        last = F.least(F.size("_starts") - 1, F.col(CHUNK) + reach)
        later = F.when(last > F.col(CHUNK), F.sequence(F.col(CHUNK) + 1, last))
        into = F.filter(later, lambda c: F.get(F.col("_starts"), c) - rows <= at)
        return (
            placed.withColumn(CHUNK, F.explode(into))
            .withColumn(HALO, F.lit(True))
            .drop("_nth", "_starts")
        )

    def running(
        self, sums: dict[str, Column], totals: dict[str, Column] | None = None
    ) -> "Ordered":
        """Add running sums, current row included, and sums over the whole key.

        Inputs must be exact types (decimal, long), so that splitting a sum changes nothing.
        """
        totals = totals or {}
        upto = self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        whole = Window.partitionBy(*self.group)
        within = {n: F.sum(c).over(upto) for n, c in sums.items()}
        within |= {n: F.sum(c).over(whole) for n, c in totals.items()}
        if not self.cut:
            return replace(self, df=self.df.withColumns(within))
        per_chunk = (
            self.df.filter(F.col(CHUNK).isNotNull())
            .groupBy(*self.group)
            .agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in (sums | totals).items()])
        )
        by_key = Window.partitionBy(*self.keys)
        before = by_key.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        carry = per_chunk.select(
            *self.group,
            *[F.sum(f"_sum_{n}").over(before).alias(f"_carry_{n}") for n in sums],
            *[F.sum(f"_sum_{n}").over(by_key).alias(f"_carry_{n}") for n in totals],
        )
        joined = join_on(self.df.withColumns(within), F.broadcast(carry), self.group, "left")
        # NULL stands for "no value yet" on either side of the border.
        finished = {
            n: F.coalesce(F.col(n) + F.col(f"_carry_{n}"), F.col(n), F.col(f"_carry_{n}"))
            for n in sums
        }
        finished |= {n: F.coalesce(F.col(f"_carry_{n}"), F.col(n)) for n in totals}
        typed = {n: c.cast(joined.schema[n].dataType) for n, c in finished.items()}
        return replace(
            self, df=joined.withColumns(typed).drop(*[f"_carry_{n}" for n in finished])
        )

    def result(self) -> DataFrame:
        return self.df.drop(CHUNK) if self.cut else self.df


def _places(df: DataFrame, order: Sequence[str]) -> list[Column]:
    """The order columns as values that can travel: instants as microseconds, whatever zone the driver is in."""
    instant = {c for c in order if isinstance(df.schema[c].dataType, T.TimestampType)}
    return [(F.unix_micros(c) if c in instant else F.col(c)).alias(c) for c in order]


def _cut_points(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    hot: DataFrame,
    hot_rows: int,
    per_chunk: int,
) -> tuple[dict[tuple, list[tuple]], dict[tuple, list[int]]]:
    """First order values of every chunk but the first, and rows before every chunk, per hot key."""
    narrow = join_on(
        df.select(*keys, *_places(df, order)), F.broadcast(hot.drop("_rows")), keys, "left_semi"
    )
    # Tasks follow the rows; a task's sorted rows are cut into as many pieces as are wanted.
    wanted = max(2, math.ceil(2 * hot_rows / per_chunk))
    shuffled = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(wanted, max(shuffled, math.ceil(hot_rows / ROWS_PER_TASK)))
    place = F.monotonically_increasing_id()  # the task, then 33 bits for the row in it
    pieces = (
        narrow.repartitionByRange(tasks, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_place", place)
        .withColumn("_piece", F.col("_place") - F.pmod(F.col("_place").bitwiseAND((1 << 33) - 1), F.lit(max(1, per_chunk // 2))))
        .groupBy(*keys, "_piece")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min(F.struct(*order)).alias("_first"), F.max(F.struct(*order)).alias("_last"))
        .collect()
    )
    chunks: dict[tuple, list[list]] = {}
    last: dict[tuple, Row] = {}
    for row in sorted(pieces, key=lambda r: r["_piece"]):
        key = tuple(row[k] for k in keys)
        of_key = chunks.setdefault(key, [])
        # Rows of equal place are never parted: a cut is a value.
        if of_key and (of_key[-1][1] < per_chunk // 2 or last[key] == row["_first"]):
            of_key[-1][1] += row["_rows"]
        else:
            of_key.append([tuple(row["_first"]), row["_rows"]])
        last[key] = row["_last"]
    firsts = {k: [first for first, _ in c[1:]] for k, c in chunks.items()}
    starts = {k: [0, *accumulate(n for _, n in c[:-1])] for k, c in chunks.items()}
    return firsts, starts


def _reached(cuts: str, here: Column, longest: int) -> Column:
    """How many values of a sorted array are <= here, by halving; NULL without an array."""
    steps = [F.lit(1 << bit) for bit in reversed(range(longest.bit_length()))] or [F.lit(0)]

    def climb(at: Column, step: Column) -> Column:
        return at + F.when(F.get(F.col(cuts), at + step - 1) <= here, step).otherwise(F.lit(0))

    return F.when(F.col(cuts).isNotNull(), F.aggregate(F.array(*steps), F.lit(0), climb))


def _place(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cuts: dict[tuple, list[tuple]]
) -> DataFrame:
    """Add the chunk a row is in, NULL for keys that are not cut.

    Two broadcast look-ups, the first into every n-th cut point and the second into the n that
    follow it, so that a row passes a few hundred cut points through the join, not all.
    """
    longest = max(len(c) for c in cuts.values())
    width = max(1, math.isqrt(longest))
    points = T.ArrayType(df.select(*_places(df, order)).schema)
    key_fields = [T.StructField(k, df.schema[k].dataType) for k in keys]
    coarse = T.StructType([*key_fields, T.StructField(CUTS, points)])
    fine = T.StructType(
        [*key_fields, T.StructField(CHUNK, T.IntegerType()), T.StructField(CUTS, points)]
    )
    session = df.sparkSession
    firsts = session.createDataFrame([(*k, c[::width]) for k, c in cuts.items()], coarse)
    blocks = session.createDataFrame(
        [
            (*k, block + 1, c[block * width : (block + 1) * width])
            for k, c in cuts.items()
            for block in range(math.ceil(len(c) / width))
        ],
        fine,
    )
    here = F.struct(*_places(df, order))
    in_block = (
        join_on(df, F.broadcast(firsts), keys, "left")
        .withColumn(CHUNK, _reached(CUTS, here, math.ceil(longest / width)))
        .drop(CUTS)
    )
    place = F.coalesce(_reached(CUTS, here, width), F.lit(0))
    before = F.greatest(F.col(CHUNK) - 1, F.lit(0)) * width
    return (
        join_on(in_block, F.broadcast(blocks), [*keys, CHUNK], "left")
        .withColumn(CHUNK, F.when(F.col(CHUNK).isNotNull(), before + place))
        .drop(CUTS)
    )


@dataclass(frozen=True)
class Profile:
    """Where the hot keys of a series are cut. Plain values: made once, used by any indicator.

    It is of the rows it was made from: rows before each chunk are counted in it.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cuts: dict[tuple, list[tuple]] = field(default_factory=dict)
    starts: dict[tuple, list[int]] = field(default_factory=dict)


def _names(columns: str | Sequence[str]) -> tuple[str, ...]:
    return (columns,) if isinstance(columns, str) else tuple(columns)


def profile(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> Profile:
    """Count rows per key and find where hot keys are cut: up to two passes over key and order columns.

    Give it to indicators over the same rows in place of `rows_per_task`, and they read no row before they run.
    """
    keys, order = _names(keys), _names(order)
    found = hot_keys(df, keys, rows_per_task)
    cuts, starts = _cut_points(df, keys, order, *found) if found else ({}, {})
    return Profile(keys, order, cuts, starts)


def ordered(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str | Sequence[str],
    rows_per_task: int | Profile | None = ROWS_PER_TASK,
) -> Ordered:
    """Prepare a DataFrame for windows in order within each key.

    `order` must be unique inside a key (end it in an id), or ties have no place to be cut.
    Counting rows per key reads the input once more; a `profile` of the same rows in place of
    `rows_per_task` leaves that out, and so does None, for series whose length has a bound of its
    own, such as one bar per day.
    """
    keys, order = _names(keys), _names(order)
    if rows_per_task is None:
        return Ordered(df, keys, order)
    known = rows_per_task
    if not isinstance(known, Profile):
        known = profile(df, keys, order, known)
    elif (known.keys, known.order) != (keys, order):
        raise ValueError(f"the profile is of {known.keys} by {known.order}, not {keys} by {order}")
    if not known.cuts:
        return Ordered(df, keys, order)
    placed = _place(df, keys, order, known.cuts)
    return Ordered(placed, keys, order, cut=True, starts=known.starts)
