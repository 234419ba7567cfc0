"""Windowed streams with a watermark: bars, sliding figures, duplicates.

State is bounded by the watermark, and rows behind it are left out. Put `sinks.split_late` in front
to set them aside, or use `partials`, which has no watermark and loses none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.market import bars


def stream_bars(
    ticks: DataFrame, width: str = "1 hour", lateness: str = "1 hour", timestamp: str = "ts"
) -> DataFrame:
    """Bars per symbol; in append mode a bar appears once no tick can change it."""
    return bars(ticks.withWatermark(timestamp, lateness), width, timestamp=timestamp)


def stream_sliding(
    ticks: DataFrame,
    width: str = "1 hour",
    slide: str = "15 minutes",
    lateness: str = "1 hour",
    timestamp: str = "ts",
) -> DataFrame:
    """Trades, volume and average price per symbol in overlapping windows."""
    return (
        ticks.withWatermark(timestamp, lateness)
        .groupBy("symbol", F.window(timestamp, width, slide).alias("_window"))
        .agg(
            F.count(F.lit(1)).alias("trades"),
            F.sum("qty").alias("volume"),
            F.sum("price").alias("price_sum"),
        )
        .select(
            "symbol",
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            "trades",
            "volume",
            (F.col("price_sum").cast("double") / F.col("trades")).alias("avg_price"),
        )
    )


def stream_dedup(
    ticks: DataFrame, id_column: str = "trade_id", lateness: str = "1 hour", timestamp: str = "ts"
) -> DataFrame:
    """Each id once; ids are remembered until the watermark passes their row."""
    return ticks.withWatermark(timestamp, lateness).dropDuplicatesWithinWatermark([id_column])
