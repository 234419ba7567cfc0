"""Windowed figures of streams that lose no row, however late.

Every micro-batch leaves the partial figures of its own rows, in a place named after its number; a
reader adds the partials up. So rows may come in any order, there is no watermark to fall
behind, and the last windows are there as soon as a run ends. A batch that runs twice overwrites
its own place. `compact` replaces many partials by one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.workspace import delete_folder, is_complete, subfolders

BATCH = "batch"


def put(df: DataFrame, path: str, number: int, name: str = BATCH) -> None:
    df.write.mode("overwrite").parquet(f"{path}/{name}={number}")


def batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches that were written to their end."""
    names = [n for n in subfolders(spark, path) if n.startswith(f"{BATCH}=")]
    return sorted(int(n.split("=")[1]) for n in names if is_complete(spark, f"{path}/{n}"))


def _bar_partials(ticks: DataFrame, width: str, slide: str | None, key: str, timestamp: str) -> DataFrame:
    place = F.struct(timestamp, "trade_id")
    return ticks.groupBy(key, F.window(timestamp, width, slide).alias("_window")).agg(
        F.min(F.struct(place.alias("at"), "price")).alias("first"),
        F.max(F.struct(place.alias("at"), "price")).alias("last"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.sum("qty").alias("volume"),
        F.sum(F.col("price") * F.col("qty")).alias("value"),
        F.sum("price").alias("price_sum"),
        F.count(F.lit(1)).alias("trades"),
    )


def _added(partials: DataFrame, key: str) -> DataFrame:
    sums = {c: partials.schema[c].dataType for c in ("volume", "value", "price_sum", "trades")}
    return partials.groupBy(key, "_window").agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        *[F.sum(c).cast(kind).alias(c) for c, kind in sums.items()],
    )


def windows_to(
    path: str, width: str = "1 hour", slide: str | None = None, key: str = "symbol", timestamp: str = "ts"
) -> Callable[[DataFrame, int], None]:
    """Leave the partial figures of each batch's ticks (price, qty, trade_id) per key and window."""

    def handle(batch: DataFrame, number: int) -> None:
        put(_bar_partials(batch, width, slide, key, timestamp), path, number)

    return handle


MERGED = "merged"


def _current(spark: SparkSession, path: str) -> list[str]:
    """Folders that hold every batch once: the merged ones up to a number, and all batches after it."""
    upto = _merged(spark, path)
    after = [f"{BATCH}={n}" for n in batches(spark, path) if not upto or n > upto[-1]]
    return [f"{path}/{n}" for n in [*[f"{MERGED}={u}" for u in upto[-1:]], *after]]


def _merged(spark: SparkSession, path: str) -> list[int]:
    names = [n for n in subfolders(spark, path) if n.startswith(f"{MERGED}=")]
    return sorted(int(n.split("=")[1]) for n in names if is_complete(spark, f"{path}/{n}"))


def read_windows(spark: SparkSession, path: str, key: str = "symbol") -> DataFrame:
    """Figures per key and window over all batches so far: open to trades, as `market.bars` gives them."""
    done = _current(spark, path)
    if not done:
        raise ValueError(f"no batch has been written to {path}")
    added = _added(spark.read.parquet(*done), key)
    return added.select(
        key,
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        F.col("first.price").alias("open"),
        "high",
        "low",
        F.col("last.price").alias("close"),
        "volume",
        "value",
        "price_sum",
        "trades",
    )


def compact(spark: SparkSession, path: str, key: str = "symbol") -> None:
    """Put all partials but the newest into one, which says in its name up to which batch it goes.

    The newest stays, since its batch may be repeated after a failure. A merged folder counts once its
    job has marked it as complete, and with that readers leave out what it stands for: they see the
    old ones or the new one, at whatever step a run breaks off. What it stands for is deleted by the next
    run, so readers of the old folders are left in peace.
    """
    upto = _merged(spark, path)
    for n in batches(spark, path):
        if upto and n <= upto[-1]:
            delete_folder(spark, f"{path}/{BATCH}={n}")
    for n in upto[:-1]:
        delete_folder(spark, f"{path}/{MERGED}={n}")
    old = _current(spark, path)[:-1]
    if len(old) > 1:
        put(_added(spark.read.parquet(*old), key), path, int(old[-1].rpartition("=")[2]), MERGED)


BUCKET = "bucket"
_NO_TIME = "none"


def first_seen_to(
    path: str, ids: Sequence[str] = ("trade_id",), timestamp: str = "ts", bucket: str = "day"
) -> Callable[[DataFrame, int], None]:
    """Keep the first row of each id over all batches; copies are set aside below `path`/again.

    Copies carry the time of the row they repeat, or none like it. What was seen is kept by day (or
    another unit of `date_trunc`), so a batch opens the days of its own rows, however many batches
    there were before. Nothing is dropped: first + again = input.
    """

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("_nth", F.monotonically_increasing_id())
        keys = [*ids, timestamp]
        day = F.coalesce(F.date_format(F.date_trunc(bucket, F.col(timestamp)), "yyyyMMddHHmmss"), F.lit(_NO_TIME))
        first = rows.groupBy(*keys).agg(F.min("_nth").alias("_least"))
        marked = rows.persist()
        try:
            days = [r[0] for r in marked.select(day).distinct().collect()]  # no more than the batch spans
            # earlier batches ran to their end; this one may be here from a run that broke off
            known = [f"{path}/seen/{BUCKET}={d}/{name}" for d in days for name in subfolders(spark, f"{path}/seen/{BUCKET}={d}") if int(name.split("=")[1]) < number]
            joined = _null_safe(marked, first.select(*[F.col(k).alias(f"_f_{k}") for k in keys], "_least"), keys, "_f_")
            fresh: Column = F.col("_nth") == F.col("_least")
            if known:
                kinds = ", ".join(f"`{k}` {batch.schema[k].dataType.simpleString()}" for k in keys)
                stored = spark.read.schema(kinds).parquet(*known).select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
                joined = _null_safe(joined, stored.withColumn("_known", F.lit(True)), keys, "_k_")
                fresh = fresh & F.col("_known").isNull()
            put(joined.where(fresh).select(*batch.columns), f"{path}/first", number)
            put(joined.where(~fresh).select(*batch.columns), f"{path}/again", number)
        finally:
            marked.unpersist()
        new = spark.read.schema(batch.schema).parquet(f"{path}/first/{BATCH}={number}").select(*keys, day.alias(BUCKET), F.lit(number).alias(BATCH))
        writer = new.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BUCKET, BATCH).parquet(f"{path}/seen")

    return handle


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], mark: str) -> DataFrame:
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"{mark}{k}"))
    return left.join(right, condition, "left")
