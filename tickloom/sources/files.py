"""Bulk files with malformed rows kept aside, and dated snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.schemas import CORRUPT
from tickloom.workspace import delete_folder, subfolders

SNAPSHOT = "snapshot"
SNAPSHOT_DAYS = 30


def bulk_load(
    spark: SparkSession, path: str, file_format: str, schema: T.StructType, **options: str
) -> DataFrame:
    """CSV, JSON or Parquet with a declared schema.

    A row that does not fit keeps its text in `_corrupt` and NULLs elsewhere.
    """
    if file_format == "parquet":
        return spark.read.schema(schema).parquet(path).withColumn(CORRUPT, F.lit(None).cast("string"))
    wanted = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(wanted)
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, **options)
        .format(file_format)
        .load(path)
    )


def _stamp(as_of: str | dt.date | dt.datetime) -> dt.datetime:
    text = str(as_of)
    return dt.datetime.fromisoformat(text if len(text) > 10 else f"{text} 00:00:00")


def _number(moment: dt.datetime) -> int:
    """Name of a snapshot: its minute as a number, which sorts and compares as time does."""
    return int(moment.strftime("%Y%m%d%H%M"))


def write_snapshot(df: DataFrame, path: str, as_of: str | dt.date | dt.datetime) -> None:
    """A full copy under its minute; taking the same snapshot again replaces it."""
    folder = f"{path.rstrip('/')}/{SNAPSHOT}={_number(_stamp(as_of))}"
    df.write.mode("overwrite").parquet(folder)


def read_snapshots(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    as_of: str | dt.date | dt.datetime | None = None,
    keep_days: int = SNAPSHOT_DAYS,
) -> DataFrame:
    """All snapshots, or only those not expired on `as_of`; the others are not read at all."""
    stored = T.StructType([*schema.fields, T.StructField(SNAPSHOT, T.LongType())])
    rows = spark.read.schema(stored).parquet(path)
    if as_of is not None:
        border = _number(_stamp(as_of) - dt.timedelta(days=keep_days))
        rows = rows.filter(F.col(SNAPSHOT) > border)
    taken = F.to_timestamp(F.col(SNAPSHOT).cast("string"), "yyyyMMddHHmm")
    return rows.withColumn(SNAPSHOT, taken)


def expire_snapshots(
    spark: SparkSession,
    path: str,
    as_of: str | dt.date | dt.datetime,
    keep_days: int = SNAPSHOT_DAYS,
) -> list[str]:
    """Delete snapshots that are `keep_days` old or older."""
    border = _number(_stamp(as_of) - dt.timedelta(days=keep_days))
    expired = [
        name
        for name in subfolders(spark, path)
        if name.startswith(f"{SNAPSHOT}=") and int(name.split("=")[1]) <= border
    ]
    for name in expired:
        delete_folder(spark, f"{path.rstrip('/')}/{name}")
    return expired
