"""Technical indicators over ordered series.

Every function takes the key columns of a series and an order that ends in a unique id.
`rows_per_task` bounds how many rows of one key a task gets; see `ordered`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators import sliding
from tickloom.operators.ordered import CHUNK, ROWS_PER_TASK, Ordered, Profile, join_on, ordered

Keys = str | Sequence[str]


def _last(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), Window.currentRow)


def _with_count(frame: DataFrame, w: WindowSpec, column: str, n: int, out: str) -> DataFrame:
    """Add how many of the last n rows have a value: a running count less that of n rows ago."""
    so_far = F.count(column).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    counted = frame.withColumn("_so_far", so_far)
    return counted.withColumn(out, F.col("_so_far") - F.coalesce(F.lag("_so_far", n).over(w), F.lit(0))).drop("_so_far")


def _with_mean(frame: DataFrame, series: Ordered, price: str, n: int, out: str) -> DataFrame:
    """Add the mean of the last n prices, NULL until there are n, at the same cost for any n.

    Exact types are added up once and the sum of n rows ago is taken off. Doubles would drift that
    way and are put together from two parts of blocks.
    """
    w = series.window
    if not isinstance(frame.schema[price].dataType, (T.DecimalType, T.IntegralType)):
        made = sliding.moments(frame, series.group, series.order, n, price, "_m")
        return made.withColumn(out, sliding.filled(F.col("_m_mean"), F.col("_m_n"), n)).drop("_m_n", "_m_mean", "_m_off")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    exact = F.col(price)
    if isinstance(frame.schema[price].dataType, T.IntegralType):
        exact = exact.cast("decimal(38,0)")  # sums over a whole key may outgrow a long

    def in_frame(column: str) -> Column:
        return F.col(column) - F.coalesce(F.lag(column, n).over(w), F.lit(0))

    added = frame.withColumns(
        {"_total": F.sum(exact).over(so_far), "_prices": F.count(price).over(so_far)}
    ).withColumns({"_sum": in_frame("_total"), "_count": in_frame("_prices")})
    mean = F.col("_sum").cast("double") / F.lit(float(n))
    return added.withColumn(out, F.when(F.col("_count") == n, mean)).drop(
        "_total", "_prices", "_sum", "_count"
    )


def price_change(
    df: DataFrame, keys: Keys, order: Keys, price: str = "price", rows_per_task: int | Profile | None = ROWS_PER_TASK
) -> DataFrame:
    """Previous price, difference, and difference in percent of the previous price."""

    def build(frame: DataFrame, w: WindowSpec) -> DataFrame:
        return frame.withColumn("prev_price", F.lag(price).over(w)).withColumns(
            {
                "change": F.col(price) - F.col("prev_price"),
                "change_pct": F.try_divide(
                    (F.col(price) - F.col("prev_price")).cast("double") * 100.0,
                    F.col("prev_price").cast("double"),
                ),
            }
        )

    return ordered(df, keys, order, rows_per_task).rows_back(1, build).result()


def returns(
    df: DataFrame,
    keys: Keys,
    order: Keys,
    price: str = "price",
    n: int = 10,
    rows_per_task: int | Profile | None = ROWS_PER_TASK,
) -> DataFrame:
    """Simple and log return over one row, and rate of change over n rows."""
    now = F.col(price).cast("double")

    def build(frame: DataFrame, w: WindowSpec) -> DataFrame:
        before = F.lag(price).over(w).cast("double")
        earlier = F.lag(price, n).over(w).cast("double")
        return frame.withColumns(
            {
                "simple_return": F.try_divide(now - before, before),
                "log_return": F.ln(F.try_divide(now, before)),
                "rate_of_change": F.try_divide((now - earlier) * 100.0, earlier),
            }
        )

    return ordered(df, keys, order, rows_per_task).rows_back(n, build).result()


def sma(
    df: DataFrame,
    keys: Keys,
    order: Keys,
    price: str = "price",
    n: int = 20,
    rows_per_task: int | Profile | None = ROWS_PER_TASK,
) -> DataFrame:
    """Simple moving average over n rows."""

    series = ordered(df, keys, order, rows_per_task)

    def build(frame: DataFrame, w: WindowSpec) -> DataFrame:
        return _with_mean(frame, series, price, n, "sma")

    return series.rows_back(n - 1, build).result()


def bollinger(
    df: DataFrame,
    keys: Keys,
    order: Keys,
    price: str = "price",
    n: int = 20,
    k: float = 2.0,
    rows_per_task: int | Profile | None = ROWS_PER_TASK,
) -> DataFrame:
    """Moving average and the bands k population standard deviations around it."""

    series = ordered(df, keys, order, rows_per_task)

    def build(frame: DataFrame, w: WindowSpec) -> DataFrame:
        band = F.lit(k) * F.sqrt(F.col("_p_off") / n)
        made = sliding.moments(_with_mean(frame, series, price, n, "middle"), series.group, series.order, n, price, "_p")
        full = sliding.filled(band, F.col("_p_n"), n)
        return made.withColumns({"upper": F.col("middle") + full, "lower": F.col("middle") - full}).drop("_p_n", "_p_mean", "_p_off")

    return series.rows_back(n - 1, build).result()


def volatility(
    df: DataFrame,
    keys: Keys,
    order: Keys,
    price: str = "price",
    n: int = 20,
    rows_per_task: int | Profile | None = ROWS_PER_TASK,
) -> DataFrame:
    """Sample standard deviation of the last n log returns."""

    series = ordered(df, keys, order, rows_per_task)

    def build(frame: DataFrame, w: WindowSpec) -> DataFrame:
        now = F.col(price).cast("double")
        step = F.ln(F.try_divide(now, F.lag(price).over(w).cast("double")))
        made = sliding.moments(frame.withColumn("_step", step), series.group, series.order, n, "_step", "_s")
        deviation = F.sqrt(F.try_divide(F.col("_s_off"), F.lit(n - 1.0)))
        return made.withColumn("volatility", sliding.filled(deviation, F.col("_s_n"), n)).drop("_step", "_s_n", "_s_mean", "_s_off")

    return series.rows_back(n, build).result()


def stochastic(
    df: DataFrame,
    keys: Keys,
    order: Keys,
    n: int = 14,
    smooth: int = 3,
    rows_per_task: int | Profile | None = ROWS_PER_TASK,
) -> DataFrame:
    """%K and %D over bars with high, low and close; NULL where the range is flat."""

    series = ordered(df, keys, order, rows_per_task)

    def build(frame: DataFrame, w: WindowSpec) -> DataFrame:
        reach = {"_floor": ("min", "low"), "_top": ("max", "high")}
        made = sliding.extrema(frame, series.group, series.order, n, reach)
        made = _with_count(made, w, "close", n, "_closes")
        floor = F.col("_floor").cast("double")
        k = F.try_divide((F.col("close").cast("double") - floor) * 100.0, F.col("_top").cast("double") - floor)
        made = made.withColumn("percent_k", sliding.filled(k, F.col("_closes"), n)).drop("_floor", "_top", "_closes")
        made = sliding.moments(made, series.group, series.order, smooth, "percent_k", "_k")
        d = sliding.filled(F.col("_k_mean"), F.col("_k_n"), smooth)
        return made.withColumn("percent_d", d).drop("_k_n", "_k_mean", "_k_off")

    return series.rows_back(n + smooth - 2, build).result()


def _exact(df: DataFrame, column: str, room: int, digits: int) -> tuple[Column, int, int]:
    """A column as a decimal with its precision and scale.

    Decimals stay as they are; others get `room` digits at most, and doubles `digits` behind the point.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        return F.col(column), kind.precision, kind.scale
    size, scale = (min(19, room), 0) if isinstance(kind, T.IntegralType) else (room, digits)
    return F.col(column).cast(f"decimal({size},{scale})"), size, scale


def vwap(
    df: DataFrame,
    keys: Keys,
    day: str,
    order: Keys,
    price: str = "price",
    quantity: str = "qty",
    rows_per_task: int | Profile | None = ROWS_PER_TASK,
) -> DataFrame:
    """Volume-weighted average price since the start of the day.

    Products keep all digits of a decimal price; of doubles, prices are taken to 12 decimals and
    quantities to 4, so that sums over chunks are exact.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    value, size, value_scale = _exact(df, price, 22, 12)
    # a product of more than 38 digits would lose some behind the point
    traded, _, traded_scale = _exact(df, quantity, max(10, 37 - size), 4)
    digits = min(18, value_scale + traded_scale)
    sums = {"_value": (value * traded).cast(f"decimal(38,{digits})"), "_quantity": traded}
    summed = ordered(df, [*keys, day], order, rows_per_task).running(sums).result()
    ratio = F.try_divide(F.col("_value").cast("double"), F.col("_quantity").cast("double"))
    return summed.withColumn("vwap", ratio).drop("_value", "_quantity")


def obv(
    df: DataFrame,
    keys: Keys,
    order: Keys,
    price: str = "close",
    quantity: str = "volume",
    rows_per_task: int | Profile | None = ROWS_PER_TASK,
) -> DataFrame:
    """On-balance volume: quantity added when the price rises and taken off when it falls."""

    def direction(frame: DataFrame, w: WindowSpec) -> DataFrame:
        change = F.col(price) - F.lag(price).over(w)
        sign = F.when(change > 0, 1).when(change < 0, -1).otherwise(0)
        return frame.withColumn("_flow", sign * F.col(quantity))

    return (
        ordered(df, keys, order, rows_per_task)
        .rows_back(1, direction)
        .running({"obv": F.col("_flow")})
        .result()
        .drop("_flow")
    )


# Recursive indicators -----------------------------------------------------------------
#
# All of them are exponential smoothings y += alpha * (x - y) that start at the first x there
# is. Windows prepare x; the smoothing itself has no built-in, so it runs on Arrow batches in the
# window's own order, carrying one state per output from batch to batch. Only the smoothed
# columns become numpy arrays; all others pass through.

FIRST = "_first"
ENTER = "_enter"


def ema_alpha(n: int) -> float:
    return 2.0 / (n + 1)


Steps = Sequence[tuple[str, float, tuple[str, ...]]]


def _exponential(x: np.ndarray, groups: np.ndarray, alpha: float) -> np.ndarray:
    """y += alpha * (x - y) in each group from its first value on; missing values change nothing."""
    grouped = pd.Series(x).groupby(groups, sort=False)
    return grouped.ewm(alpha=alpha, adjust=False, ignore_na=True).mean().to_numpy()


def _inputs(batch: pa.RecordBatch, steps: Steps) -> dict[str, np.ndarray]:
    names = {n for _, _, inputs in steps for n in inputs} & set(batch.schema.names)
    return {n: batch.column(n).to_numpy(zero_copy_only=False).astype(float) for n in names}


def _of(values: dict[str, np.ndarray], inputs: tuple[str, ...]) -> np.ndarray:
    return values[inputs[0]] if len(inputs) == 1 else values[inputs[0]] - values[inputs[1]]


def _smooth_partition(steps: Steps, entered: bool):
    """Arrow function that adds a smoothed column per step (output, alpha, inputs).

    With two inputs the difference of the first and the second is smoothed; an input may be the
    output of an earlier step. If `entered`, the first row of a group holds the values that the
    smoothing goes on from, or NULLs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: list[float | None] = [None] * len(steps)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            first = batch.column(FIRST).to_numpy(zero_copy_only=False).astype(bool)
            groups = np.cumsum(first)
            values = _inputs(batch, steps)
            for i, (out, alpha, inputs) in enumerate(steps):
                # a value to go on from stands before the rows it is for
                enter = np.full(len(first), np.nan)
                if entered:
                    given = batch.column(f"{ENTER}{i}").to_numpy(zero_copy_only=False).astype(float)
                    enter[first] = given[first]
                if states[i] is not None and groups[0] == 0:
                    enter[0] = states[i]
                at = np.flatnonzero(~np.isnan(enter))
                x = np.insert(_of(values, inputs), at, enter[at])
                y = _exponential(x, np.insert(groups, at, groups[at]), alpha)
                values[out] = np.delete(y, at + np.arange(len(at)))
                last = values[out][-1]
                states[i] = None if np.isnan(last) else float(last)
            new = [pa.array(values[out], from_pandas=True) for out, _, _ in steps]
            names = [*batch.schema.names, *[out for out, _, _ in steps]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names)

    return run


def _ends(values: dict[str, np.ndarray], steps: Steps, start: np.ndarray | None) -> np.ndarray:
    """States behind some consecutive rows, from the states before them or from none."""
    n = len(next(iter(values.values())))
    values, ends = dict(values), np.full(len(steps), np.nan)
    for i, (out, alpha, inputs) in enumerate(steps):
        x = _of(values, inputs)
        if start is not None:
            x = np.insert(x, 0, start[i])
        y = _exponential(x, np.zeros(len(x), int), alpha)
        values[out], ends[i] = y[len(y) - n :], y[-1]
    return ends


def _passage(steps: Steps, key: Sequence[str]):
    """Arrow function that sums up each chunk as what it does to the states that enter it.

    Smoothing is linear: states s leave as map s + offset. `fresh` are the states that leave if
    none enter, NULL if the chunk has no value. Chunks may come in several batches.
    """
    size = len(steps)

    def of(values: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        nothing = {n: x * 0.0 for n, x in values.items()}  # missing values stay missing
        columns = [_ends(nothing, steps, unit) for unit in np.eye(size)]
        return np.stack(columns, axis=1), _ends(values, steps, np.zeros(size)), _ends(values, steps, None)

    def row(names: list, passed: tuple) -> pa.RecordBatch:
        scale, offset, fresh = passed
        known = None if np.isnan(fresh).any() else fresh.tolist()
        columns = [*names, pa.array([scale.ravel().tolist()]), pa.array([offset.tolist()])]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array([known], pa.list_(pa.float64()))], [*key, "scale", "offset", "fresh"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            first = np.flatnonzero(batch.column(FIRST).to_numpy(zero_copy_only=False).astype(bool))
            values = _inputs(batch, steps)
            cuts = [*([] if len(first) and first[0] == 0 else [0]), *first.tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                scale, offset, fresh = of({n: x[a:b] for n, x in values.items()})
                if held is not None and not (len(first) and a in first):
                    begun = ~np.isnan(held[2]).any()
                    fresh = scale @ held[2] + offset if begun else fresh
                    scale, offset = scale @ held[0], scale @ held[1] + offset
                elif held is not None:
                    yield row(names, held)
                names = [batch.column(k).slice(a, 1) for k in key]
                held = scale, offset, fresh
        if held is not None:
            yield row(names, held)

    return run


def _entering(steps: Steps, keys: Sequence[str], chunk: str):
    """States that enter each chunk of a key, from the chunks' passages in order."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(chunk)
        size, state, enter = len(steps), None, []
        for scale, offset, fresh in zip(*(table.column(c).to_pylist() for c in ("scale", "offset", "fresh"))):
            enter.append(state)
            if state is not None:
                state = np.reshape(scale, (size, size)) @ state + offset
            elif fresh is not None:
                state = np.array(fresh)
        columns = [
            pa.array([None if s is None else float(s[i]) for s in enter], pa.float64())
            for i in range(size)
        ]
        return pa.table(
            [*(table.column(k) for k in keys), table.column(chunk), *columns],
            [*keys, chunk, *[f"{ENTER}{i}" for i in range(size)]],
        )

    return run


def _smooth(series: Ordered, rows: int, prepare, steps: Steps) -> Ordered:
    """Prepare inputs with windows looking back `rows` rows, then smooth them.

    A cut key is smoothed from chunk to chunk: what each chunk does to the states is summed up in
    one row, a key's rows are gone through in order, and every chunk then starts from its exact states.
    """
    made = series.rows_back(rows, prepare)
    number = F.row_number().over(made.window) == 1
    ready = made.df.withColumn(FIRST, number)
    outputs = [T.StructField(out, T.DoubleType()) for out, _, _ in steps]
    if made.cut:
        keys = [made.df.schema[k] for k in made.keys]
        chunk = T.StructField(CHUNK, T.IntegerType())
        numbers = T.ArrayType(T.DoubleType())
        sums = [T.StructField(n, numbers) for n in ("scale", "offset", "fresh")]
        enter = [T.StructField(f"{ENTER}{i}", T.DoubleType()) for i in range(len(steps))]
        given = sorted({n for _, _, inputs in steps for n in inputs} & set(ready.columns))
        cut = ready.filter(F.col(CHUNK).isNotNull()).withColumn(CHUNK, F.col(CHUNK).cast("int"))
        passages = (
            cut.sortWithinPartitions(*made.group, *made.order)
            .select(*made.group, FIRST, *given)
            .mapInArrow(_passage(steps, made.group), T.StructType([*keys, chunk, *sums]))
        )
        states = passages.groupBy(*made.keys).applyInArrow(
            _entering(steps, made.keys, CHUNK), T.StructType([*keys, chunk, *enter])
        )
        ready = join_on(ready, F.broadcast(states), made.group, "left")
    # The window left the rows in this order, so the sort is dropped from the plan.
    ready = ready.sortWithinPartitions(*made.group, *made.order)
    schema = T.StructType([*ready.schema.fields, *outputs])
    done = ready.mapInArrow(_smooth_partition(steps, made.cut), schema).drop(FIRST)
    return replace(made, df=done.drop(*[f"{ENTER}{i}" for i in range(len(steps))]))


def ema(
    df: DataFrame,
    keys: Keys,
    order: Keys,
    price: str = "price",
    n: int = 12,
    rows_per_task: int | Profile | None = ROWS_PER_TASK,
) -> DataFrame:
    """Exponential moving average with alpha 2 / (n + 1), starting at the first price."""
    series = ordered(df, keys, order, rows_per_task)

    def prepare(frame: DataFrame, w: WindowSpec) -> DataFrame:
        return frame.withColumn("_x", F.col(price).cast("double"))

    return _smooth(series, 0, prepare, [("ema", ema_alpha(n), ("_x",))]).result().drop("_x")


def macd(
    df: DataFrame,
    keys: Keys,
    order: Keys,
    price: str = "price",
    fast: int = 12,
    slow: int = 26,
    signal: int = 9,
    rows_per_task: int | Profile | None = ROWS_PER_TASK,
) -> DataFrame:
    """Difference of a fast and a slow EMA, the EMA of that, and what is between the two."""
    series = ordered(df, keys, order, rows_per_task)

    def prepare(frame: DataFrame, w: WindowSpec) -> DataFrame:
        return frame.withColumn("_x", F.col(price).cast("double"))

    steps = [
        ("_fast", ema_alpha(fast), ("_x",)),
        ("_slow", ema_alpha(slow), ("_x",)),
        ("macd_signal", ema_alpha(signal), ("_fast", "_slow")),
    ]
    smoothed = _smooth(series, 0, prepare, steps).result()
    line = F.col("_fast") - F.col("_slow")
    return smoothed.withColumns(
        {"macd": line, "macd_histogram": line - F.col("macd_signal")}
    ).drop("_x", "_fast", "_slow")


def _seeded(x: Column, w: WindowSpec, n: int, first_row: int) -> Column:
    """Wilder's input: nothing until n values are there, then their mean, then each value.

    `_place` is the row's number in its whole key.
    """
    seed_at = first_row + n - 1
    return (
        F.when(F.col(PLACE) < seed_at, F.lit(None).cast("double"))
        .when(F.col(PLACE) == seed_at, F.avg(x).over(_last(w, n)))
        .otherwise(x)
    )


PLACE = "_place"


def rsi(
    df: DataFrame,
    keys: Keys,
    order: Keys,
    price: str = "price",
    n: int = 14,
    rows_per_task: int | Profile | None = ROWS_PER_TASK,
) -> DataFrame:
    """Relative strength by Wilder's smoothing; NULL for the first n rows.

    100 where nothing has been lost so far, and 50 where nothing has moved at all. Both are told by
    counts of rises and falls, so a series that halts keeps its value. Where it has done both and then
    stands still until both means are zero in doubles, some ten thousand rows, it is 50 again.
    """
    moved = ordered(df, keys, order, rows_per_task).rows_back(1, lambda frame, w: frame.withColumn("_change", (F.col(price) - F.lag(price).over(w)).cast("double")))
    count = lambda which: F.when(which, 1).otherwise(0)
    series = moved.running({PLACE: F.lit(1), "_rises": count(F.col("_change") > 0), "_falls": count(F.col("_change") < 0)})

    def prepare(frame: DataFrame, w: WindowSpec) -> DataFrame:
        known = F.col("_change").isNotNull()
        split = frame.withColumns(
            {
                "_gain": F.when(known, F.greatest("_change", F.lit(0.0))),
                "_loss": F.when(known, F.greatest(-F.col("_change"), F.lit(0.0))),
            }
        )
        return split.withColumns(
            {
                "_gain_in": _seeded(F.col("_gain"), w, n, 2),
                "_loss_in": _seeded(F.col("_loss"), w, n, 2),
            }
        ).drop("_change", "_gain", "_loss")

    steps = [("_up", 1.0 / n, ("_gain_in",)), ("_down", 1.0 / n, ("_loss_in",))]
    smoothed = _smooth(series, n, prepare, steps).result()
    up, down = F.col("_up"), F.col("_down")
    strength = (
        F.when((F.col("_rises") == 0) & (F.col("_falls") == 0), 50.0)
        .when(F.col("_falls") == 0, 100.0)
        .when(F.col("_rises") == 0, 0.0)
        .otherwise(F.coalesce(F.try_divide(100.0 * up, up + down), F.lit(50.0)))
    )
    return smoothed.withColumn("rsi", F.when(up.isNotNull(), strength)).drop(
        "_gain_in", "_loss_in", "_up", "_down", PLACE, "_rises", "_falls"
    )


def atr(
    df: DataFrame, keys: Keys, order: Keys, n: int = 14, rows_per_task: int | Profile | None = ROWS_PER_TASK
) -> DataFrame:
    """Average true range of bars by Wilder's smoothing; NULL for the first n - 1 rows."""
    series = ordered(df, keys, order, rows_per_task).running({PLACE: F.lit(1)})

    def prepare(frame: DataFrame, w: WindowSpec) -> DataFrame:
        before = F.lag("close").over(w)
        # greatest skips NULLs, so the first bar has its own range.
        true_range = F.greatest(
            F.col("high") - F.col("low"),
            F.abs(F.col("high") - before),
            F.abs(F.col("low") - before),
        )
        return (
            frame.withColumn("_range", true_range.cast("double"))
            .withColumn("_range_in", _seeded(F.col("_range"), w, n, 1))
            .drop("_range")
        )

    steps = [("atr", 1.0 / n, ("_range_in",))]
    return _smooth(series, n, prepare, steps).result().drop("_range_in", PLACE)
