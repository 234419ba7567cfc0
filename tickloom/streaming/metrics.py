"""Batch metrics of a stream without a second pass: counted while the rows pass to their sink.

`watched` puts counters into the stream, Spark sends them with each batch's progress, and
`BatchMetrics` writes them, so neither the input nor the sink is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tickloom.operators.validate import REASONS
from tickloom.workspace import subfolders

BATCH = "batch"
_WRITTEN = f"operation string, {BATCH} bigint, records_processed bigint, rows_failed bigint, processing_time double"


def watched(checked: DataFrame, operation: str) -> DataFrame:
    """The same stream, whose rows bear `reasons`, with its rows and failed rows counted under a name."""
    failed = F.count_if(F.size(REASONS) > 0)
    return checked.observe(operation, F.count(F.lit(1)).alias("rows"), failed.alias("rows_failed"))


class BatchMetrics(StreamingQueryListener):
    """Writes one row for each batch of a watched stream that had rows, below a path.

    A batch's row has a place of its own and overwrites it, so a batch that runs twice counts once.
    """

    def __init__(self, spark: SparkSession, path: str, operation: str):
        self.spark, self.path, self.operation = spark, path, operation

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(self.operation)
        if seen is not None and seen["rows"]:
            seconds = progress.durationMs.get("triggerExecution", 0) / 1000
            row = (self.operation, progress.batchId, seen["rows"], seen["rows_failed"], seconds)
            self.spark.createDataFrame([row], _WRITTEN).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{BATCH}={progress.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def attach(spark: SparkSession, path: str, operation: str) -> BatchMetrics:
    """Listen to the session's streams; hand the result to `detach` when they have ended."""
    listener = BatchMetrics(spark, path, operation)
    spark.streams.addListener(listener)
    return listener


def detach(listener: BatchMetrics, seconds: int = 60) -> None:
    """Stop listening once everything that has happened is written: progress is told after a query's end."""
    listener.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(seconds * 1000)
    listener.spark.streams.removeListener(listener)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Operation, batch, rows, failed rows, seconds and success rate of every batch: input of `monitor.batch_metrics`."""
    folders = [f"{path}/{n}" for n in subfolders(spark, path)]
    kinds = _WRITTEN
    rows = spark.read.schema(kinds).parquet(*folders) if folders else spark.createDataFrame([], kinds)
    return rows.withColumn("success_rate", 1 - F.col("rows_failed") / F.col("records_processed"))
