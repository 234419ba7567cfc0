"""Figures over the last n rows at a cost that does not depend on n.

A frame that slides is computed anew for every row, which costs n each. Here the rows of a
series are cut into blocks of n. The last n rows are then the end of one block and the beginning of
the next (or one whole block), and both parts are running figures of their block: one in order, one
in reverse. Extrema and moments (count, mean, sum of squared deviations) of two parts make those of
their union, without taking anything off a sum, so doubles lose no digits. Blocks are parts of the
group that a task holds already: they cost sorts inside the task and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: Frames up to this many rows are cheaper computed anew than put together.
NARROW = 64

_PLACE = "_in_group"
_BLOCK = "_block"


def _blocks(frame: DataFrame, w: WindowSpec, n: int) -> DataFrame:
    place = F.row_number().over(w) - 1
    return frame.withColumn(_PLACE, place).withColumn(_BLOCK, F.floor(F.col(_PLACE) / n))


def _runs(group: Sequence[str], order: Sequence[str]) -> tuple[WindowSpec, WindowSpec]:
    """Windows from a block's begin to a row, and from a row to the block's end."""
    block = Window.partitionBy(*group, _BLOCK)
    upto = (Window.unboundedPreceding, Window.currentRow)
    return block.orderBy(*order).rowsBetween(*upto), block.orderBy(*[F.desc(c) for c in order]).rowsBetween(*upto)


def extrema(
    frame: DataFrame, group: Sequence[str], order: Sequence[str], n: int, wanted: dict[str, tuple[str, str]]
) -> DataFrame:
    """Add the 'min' or 'max' of a column over the last n rows: `wanted` is name -> (which, column).

    `order` is ascending and unique in a group. NULLs count for nothing; the first rows of a group
    have what there is.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    figure = {"min": F.min, "max": F.max}
    if n <= NARROW:
        last = w.rowsBetween(-(n - 1), Window.currentRow)
        return frame.withColumns({name: figure[which](c).over(last) for name, (which, c) in wanted.items()})
    ahead, back = _runs(group, order)
    cut = _blocks(frame, w, n)
    cut = cut.withColumns({f"_ahead_{name}": figure[which](c).over(ahead) for name, (which, c) in wanted.items()})
    cut = cut.withColumns({f"_back_{name}": figure[which](c).over(back) for name, (which, c) in wanted.items()})
    both = {"min": F.least, "max": F.greatest}
    joined = {name: both[which](f"_ahead_{name}", F.lag(f"_back_{name}", n - 1).over(w)) for name, (which, _) in wanted.items()}
    return cut.withColumns(joined).drop(_PLACE, _BLOCK, *[f"_{side}_{name}" for name in wanted for side in ("ahead", "back")])


def _moments(x: Column, w: WindowSpec, side: str) -> dict[str, Column]:
    count = F.count(x).over(w)
    return {
        f"_{side}_n": count,
        f"_{side}_mean": F.coalesce(F.avg(x).over(w), F.lit(0.0)),
        f"_{side}_off": F.coalesce(F.var_pop(x).over(w), F.lit(0.0)) * count,
    }


def moments(
    frame: DataFrame, group: Sequence[str], order: Sequence[str], n: int, value: str, out: str
) -> DataFrame:
    """Add `out`_n, `out`_mean and `out`_off: count, mean and sum of squared deviations of the last n values.

    The mean is NULL without values. `order` is ascending and unique in a group.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    x = F.col(value).cast("double")
    if n <= NARROW:
        last = w.rowsBetween(-(n - 1), Window.currentRow)
        count = F.count(x).over(last)
        return frame.withColumns({f"{out}_n": count, f"{out}_mean": F.avg(x).over(last), f"{out}_off": F.var_pop(x).over(last) * count})
    ahead, back = _runs(group, order)
    cut = _blocks(frame, w, n).withColumns(_moments(x, ahead, "ahead")).withColumns(_moments(x, back, "back"))
    # the block's last row has the whole frame ahead of it already
    spans = F.col(_PLACE) % n != n - 1
    before = {c: F.when(spans, F.lag(f"_back_{c}", n - 1).over(w)) for c in ("n", "mean", "off")}
    cut = cut.withColumns({f"_before_{c}": F.coalesce(v, F.lit(0)) for c, v in before.items()})
    a, b = F.col("_before_n"), F.col("_ahead_n")
    apart = F.col("_ahead_mean") - F.col("_before_mean")
    total = a + b
    mean = F.col("_before_mean") + F.try_divide(apart * b, total)
    off = F.col("_before_off") + F.col("_ahead_off") + F.coalesce(F.try_divide(apart * apart * a * b, total), F.lit(0.0))
    made = {f"{out}_n": total, f"{out}_mean": F.when(total > 0, mean), f"{out}_off": F.when(total > 0, off)}
    return cut.withColumns(made).drop(_PLACE, _BLOCK, *[f"_{s}_{c}" for s in ("ahead", "back", "before") for c in ("n", "mean", "off")])


def filled(value: Column, count: Column, n: int) -> Column:
    """The value once all n rows of the frame have one, NULL before."""
    return F.when(count == n, value)
