"""Sinks that handle a whole micro-batch: late rows, quarantine, latest table, running EMA.

Each batch writes to a place named after its number and overwrites it, so a batch that is
run again after a failure leaves the same result as one that ran once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.indicators import ema
from tickloom.operators.market import latest
from tickloom.operators.monitor import broadcast_if_small
from tickloom.operators.ordered import ROWS_PER_TASK, join_on
from tickloom.operators.validate import split_valid, validate
from tickloom.sources.feeds import paced
from tickloom.streaming.partials import BATCH, put as _put
from tickloom.workspace import delete_folder, is_complete, read_text, subfolders, write_text

VERSION = "version"


def each_batch(
    rows: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    seconds: int | None = None,
) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return paced(writer, seconds).start()


def split_late(
    path: str, lateness: str, timestamp: str = "ts"
) -> Callable[[DataFrame, int], None]:
    """Write on-time and late rows apart, below `path`.

    A row is late when it is older than the newest time of all earlier batches minus
    `lateness`. The engine does not tell a batch its watermark, so the newest time of each
    batch is kept in a small table.
    """

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        marks = f"{path}/marks"
        limit = F.lit(None).cast("timestamp")
        if subfolders(spark, marks):
            earlier = spark.read.schema(f"newest timestamp, {BATCH} bigint").parquet(marks)
            newest = earlier.filter(F.col(BATCH) < number).agg(F.max("newest")).first()[0]
            if newest is not None:
                limit = F.lit(newest) - F.expr(f"INTERVAL {lateness}")
        is_late = F.coalesce(F.col(timestamp) < limit, F.lit(False))
        marked = batch.withColumn("is_late", is_late)
        (
            marked.write.mode("overwrite")
            .partitionBy("is_late")
            .parquet(f"{path}/rows/{BATCH}={number}")
        )
        _put(batch.agg(F.max(timestamp).alias("newest")), marks, number)

    return handle


def late_counts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows and late rows per batch."""
    stored = f"{schema}, {BATCH} bigint, is_late boolean"
    rows = spark.read.schema(stored).parquet(f"{path}/rows")
    return rows.groupBy(BATCH).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("is_late").alias("late_rows")
    )


def quarantine_to(path: str, rules: dict[str, Column]) -> Callable[[DataFrame, int], None]:
    """Write valid rows and quarantined rows apart; rules must need one row only."""

    def handle(batch: DataFrame, number: int) -> None:
        checked = validate(batch, rules).persist()
        try:
            good, bad = split_valid(checked)
            _put(good, f"{path}/valid", number)
            _put(bad, f"{path}/quarantine", number)
        finally:
            checked.unpersist()

    return handle


BUCKETS = 64
BUCKET = "bucket"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)


def _same_buckets(spark: SparkSession, path: str, buckets: int) -> None:
    """A key's rows are looked for in one bucket, so a table goes on with the number it began with."""
    name = "_buckets"
    write_text(spark, f"{path}/{name}", str(buckets))
    begun = int(read_text(spark, f"{path}/{name}"))
    if begun != buckets:
        raise ValueError(f"{path} has {begun} buckets, not {buckets}")


def _stored(spark: SparkSession, path: str, below: int | None = None) -> dict[int, list[int]]:
    """Versions of each bucket, oldest first, of batches written to their end."""
    found: dict[int, list[int]] = {}
    for v in _versions(spark, path):
        if below is None or v < below:
            for name in subfolders(spark, f"{path}/{VERSION}={v}"):
                if name.startswith(f"{BUCKET}="):
                    found.setdefault(int(name.split("=")[1]), []).append(v)
    return found


def _read(spark: SparkSession, path: str, schema, stored: dict[int, list[int]]) -> DataFrame:
    """The newest version of each bucket."""
    folders = [f"{path}/{VERSION}={v[-1]}/{BUCKET}={b}" for b, v in stored.items()]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _touched(
    batch: DataFrame, path: str, keys: Sequence[str], number: int, buckets: int
) -> dict[int, list[int]]:
    """What is stored before batch `number` of the buckets that its keys fall into."""
    _same_buckets(batch.sparkSession, path, buckets)
    own = {r[0] for r in batch.select(_bucket(keys, buckets)).distinct().collect()}
    known = _stored(batch.sparkSession, path, number)
    return {b: v for b, v in known.items() if b in own}


def _replace(
    rows: DataFrame, path: str, keys: Sequence[str], number: int, buckets: int, stored: dict[int, list[int]], keep: int
) -> None:
    """Write the buckets of `rows` as version `number`, and delete those with `keep` newer ones."""
    # a file or few for each bucket, not one from each task
    marked = rows.withColumn(BUCKET, _bucket(keys, buckets)).repartition(F.col(BUCKET))
    marked.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/{VERSION}={number}")
    for b, versions in stored.items():
        for old in versions[: -(keep - 1) or None]:
            delete_folder(rows.sparkSession, f"{path}/{VERSION}={old}/{BUCKET}={b}")


def keep_latest(
    path: str,
    keys: Sequence[str],
    timestamp: str,
    tiebreak: Sequence[str],
    keep: int = 2,
    buckets: int = BUCKETS,
) -> Callable[[DataFrame, int], None]:
    """Maintain a table of the newest row per key, in `buckets` by a hash of the key.

    Batch n reads the newest version before n of the buckets that its keys fall into and writes
    those alone as version n. Of each bucket the last `keep` versions stay, so readers of the current
    one are left in peace; a batch that is repeated needs the version before it, so two are the least.
    """
    if keep < 2:
        raise ValueError("keep two versions or more: a repeated batch needs the one before it")

    def handle(batch: DataFrame, number: int) -> None:
        stored = _touched(batch, path, keys, number, buckets)
        rows = _read(batch.sparkSession, path, batch.schema, stored).unionByName(batch)
        _replace(latest(rows, keys, timestamp, tiebreak), path, keys, number, buckets, stored, keep)

    return handle


LATE = "is_late"


def running_ema(
    path: str,
    n: int = 12,
    keys: Sequence[str] = ("symbol",),
    timestamp: str = "ts",
    trade_id: str = "trade_id",
    price: str = "price",
    rows_per_task: int = ROWS_PER_TASK,
    buckets: int = BUCKETS,
) -> Callable[[DataFrame, int], None]:
    """Continue the EMA of every key over all batches, for keys of any size.

    The last value of each key is a row in a state table. In the next batch it stands before
    the key's rows, and since an EMA starts at its first value, it goes on from there. So a
    batch is an ordinary `ema`, which cuts a key with more rows than a task should hold. Rows that are
    not after their key's state are marked late and get no value. Rows go to `path`/rows.
    """
    order = [timestamp, trade_id]

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        state = f"{path}/state"
        rows = batch.select(*keys, *order, F.col(price).cast("double").alias("_x"))
        shape = rows.schema
        stored = _touched(rows, state, keys, number, buckets)
        before = _read(spark, state, shape, stored)
        last = before.select(*keys, F.struct(*order).alias("_last"))
        placed = join_on(rows, broadcast_if_small(last), keys, "left") if stored else rows.withColumn("_last", F.lit(None).cast(last.schema["_last"].dataType))
        late = F.coalesce(F.struct(*order) <= F.col("_last"), F.lit(False))
        rows = placed.withColumn(LATE, late).drop("_last")
        go_on = before.withColumn("_state", F.lit(True)).unionByName(
            rows.filter(~F.col(LATE)).drop(LATE).withColumn("_state", F.lit(False))
        )
        smooth = ema(go_on, keys, order, "_x", n, rows_per_task).filter(~F.col("_state"))
        done = smooth.select(*keys, *order, "ema", F.lit(False).alias(LATE)).unionByName(
            rows.filter(LATE).select(
                *keys, *order, F.lit(None).cast("double").alias("ema"), F.lit(True).alias(LATE)
            )
        )
        _put(done, f"{path}/rows", number)
        written = spark.read.schema(done.schema).parquet(f"{path}/rows/{BATCH}={number}")
        on_time = written.filter(~F.col(LATE)).select(*keys, *order, F.col("ema").alias("_x"))
        newest = latest(before.unionByName(on_time), keys, timestamp, [trade_id])
        _replace(newest, state, keys, number, buckets, stored, keep=2)

    return handle


def _versions(spark: SparkSession, path: str) -> list[int]:
    names = [
        n
        for n in subfolders(spark, path)
        if n.startswith(f"{VERSION}=") and is_complete(spark, f"{path}/{n}")
    ]
    return sorted(int(n.split("=")[1]) for n in names)


def read_latest(spark: SparkSession, path: str, schema) -> DataFrame:
    """The current version of a latest table; without rows before the first batch."""
    return _read(spark, path, schema, _stored(spark, path))
