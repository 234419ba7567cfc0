"""Streams over landed feed files.

A feed client writes files into a landing folder or messages into a Kafka topic; reading them
is what is built here. A batch of the file source is bounded by bytes (or by files, if asked), since
it cannot count rows; one of the Kafka source is bounded by rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tickloom.operators.normalize import NORMALIZE
from tickloom.schemas import CORRUPT, RAW_DERIVATIVES, RAW_EQUITY, RAW_INDICES
from tickloom.sources.tables import write_load

# Seconds between two polls of each feed.
POLL_SECONDS = {"equity": 1, "derivatives": 1, "indices": 5}

# Bounds of one micro-batch, so that a backlog is worked off in pieces.
BYTES_PER_BATCH = 64 << 30
ROWS_PER_BATCH = 50_000_000


def feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    file_format: str = "json",
    files_per_batch: int | None = None,
    bytes_per_batch: int = BYTES_PER_BATCH,
    **options: str,
) -> DataFrame:
    """Stream of the records in the files of a folder or glob, as they arrive.

    A JSON or CSV record that cannot be read keeps its text in `_corrupt`.
    """
    bound = (
        {"maxFilesPerTrigger": files_per_batch}
        if files_per_batch
        else {"maxBytesPerTrigger": bytes_per_batch}
    )
    if file_format in ("json", "csv"):
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **options}
    return spark.readStream.schema(schema).format(file_format).options(**bound, **options).load(path)


def topic(
    spark: SparkSession,
    servers: str,
    name: str,
    schema: T.StructType,
    rows_per_batch: int = ROWS_PER_BATCH,
) -> DataFrame:
    """Stream of the JSON records in a Kafka topic; needs Spark's Kafka connector on the class path."""
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", name)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", rows_per_batch)
        .load()
    )
    return read_messages(messages, schema)


def read_messages(messages: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """Records from JSON messages; one that cannot be read keeps its text in `_corrupt`."""
    wanted = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(F.col(column).cast("string"), wanted, options)
    return messages.select(parsed.alias("_record")).select("_record.*")


def paced(writer: DataStreamWriter, seconds: int | None) -> DataStreamWriter:
    """Trigger every so many seconds; None takes in what is there and stops."""
    if seconds is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{seconds} seconds")


def ingest(
    rows: DataFrame,
    base: str,
    table: str,
    checkpoint: str,
    as_of: str,
    seconds: int | None = None,
) -> StreamingQuery:
    """Append a stream of typed rows to a table, laid out as a batch write lays them out.

    Each micro-batch is a load of its own, named after the checkpoint and the batch, and a batch
    that is repeated overwrites its load. So streams and batch writes share a table, and a
    restart adds no row twice.
    """
    source = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def append(batch: DataFrame, number: int) -> None:
        write_load(batch, base, table, as_of, f"{source}-{number}")

    writer = rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return paced(writer, seconds).start()


RAW = {"equity": RAW_EQUITY, "derivatives": RAW_DERIVATIVES, "indices": RAW_INDICES}


def ingest_feed(
    spark: SparkSession,
    landing: str,
    base: str,
    table: str,
    checkpoint: str,
    as_of: str,
    cadenced: bool = True,
    **bounds: int,
) -> StreamingQuery:
    """Land one of the three feeds in its table, at its cadence; without it, take in what is there."""
    records = feed(spark, landing, RAW[table], **bounds)
    rows = NORMALIZE[table](records)
    return ingest(rows, base, table, checkpoint, as_of, POLL_SECONDS[table] if cadenced else None)
