"""The five tables as month-partitioned Parquet: defaults, layout, append, read, retention."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.timing import (
    exchange_clock,
    exchange_day,
    exchange_midnight,
    month_number,
    to_millis,
    to_seconds,
)
from tickloom.schemas import TABLES, TableSpec
from tickloom.workspace import delete_folder, files_in, read_text, subfolders, write_text

MONTH = "month"
LOAD = "load"
"""Second folder level: one per write, so that a repeated one can replace itself."""


def table_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}"


def month_column(spec: TableSpec) -> Column:
    """Partition month: of the trading day, or of the instant in exchange time."""
    source = F.col(spec.month_of)
    if isinstance(spec.type_of(spec.month_of), T.TimestampType):
        source = exchange_clock(source)
    return month_number(source).cast("int")


def apply_defaults(df: DataFrame, table: str, as_of: str | dt.datetime) -> DataFrame:
    """Fill absent days and load times from `as_of`, so that a repeated load gives equal rows."""
    spec = TABLES[table]
    loaded = to_seconds(F.lit(as_of).cast("timestamp"))
    values = {c: exchange_day(loaded) for c in spec.day_default}
    values |= {c: loaded for c in spec.now_default}
    return df.withColumns(
        {c: F.coalesce(F.col(c), v) if c in df.columns else v for c, v in values.items()}
    )


def conform(df: DataFrame, table: str) -> DataFrame:
    """Exactly the declared columns, in order and type; a missing column is NULL.

    Event times hold milliseconds, load times seconds.
    """
    precision = {"timestamp": to_millis, "created_at": to_seconds}

    def stored(field: T.StructField) -> Column:
        given = F.col(field.name) if field.name in df.columns else F.lit(None)
        cut = precision.get(field.name, lambda c: c)
        return cut(given.cast(field.dataType)).alias(field.name)

    return df.select(*[stored(f) for f in TABLES[table].schema.fields])


def arrange(
    df: DataFrame, table: str, files: int | None = None, by_size: bool = False
) -> DataFrame:
    """Spread rows over tasks by month and layout order, and sort inside each task.

    Ranges rather than a hash of the month: a month is split over as many tasks as it
    needs, and every file covers a narrow key range. Rows with equal layout keys, copies
    included, are told apart by the partition they come from, so they can be split too.

    Finding ranges samples the input, which runs what lies before it twice. `by_size` leaves that
    out: rows of a month and leading key go together and Spark splits what is too large.
    """
    spec = TABLES[table]
    by = [MONTH, *spec.layout, "_from"]
    rows = conform(df, table).withColumns(
        {MONTH: month_column(spec), "_from": F.spark_partition_id()}
    )
    if by_size:
        ranged = rows.hint("rebalance", MONTH, spec.layout[0])
    else:
        ranged = rows.repartitionByRange(files, *by) if files else rows.repartitionByRange(*by)
    return ranged.sortWithinPartitions(MONTH, *spec.layout).drop("_from")


def write_table(
    df: DataFrame,
    base: str,
    table: str,
    as_of: str | dt.datetime,
    mode: str = "append",
    files: int | None = None,
    rows_per_file: int | None = None,
    by_size: bool = False,
) -> None:
    """Append to a table. Equal rows stay: the tables have no key that removes duplicates."""
    writer = arrange(apply_defaults(df, table, as_of), table, files, by_size)
    writer = writer.withColumn(LOAD, F.lit(uuid.uuid4().hex)).write.mode(mode)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy(MONTH, LOAD).parquet(table_path(base, table))


def write_load(df: DataFrame, base: str, table: str, as_of: str | dt.datetime, load: str) -> None:
    """Append rows as a named load; writing the same load again replaces it, in the months it has."""
    rows = arrange(apply_defaults(df, table, as_of), table).withColumn(LOAD, F.lit(load))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(MONTH, LOAD).parquet(table_path(base, table))


_MERGES = "_merges"
_MERGED = "merged-"
_DONE = ".done"


def compact_month(spark: SparkSession, base: str, table: str, month: int) -> None:
    """Rewrite the loads of a month as one: a stream leaves small files with each batch.

    Loads that are merged are written first, under a name that readers leave out. One small file,
    which is there or not, then names the loads it stands for, and from there on readers take it and leave
    those out. So a run that breaks off at any step changes no row, and the next one finishes it. For
    months that no stream writes to any more. A reader that listed the old loads before they are deleted
    fails and reads again.
    """
    path = table_path(base, table)
    folder = f"{path}/{MONTH}={month}"
    taken, left_out = _merges(spark, path)
    loads = [n.split("=", 1)[1] for n in subfolders(spark, folder) if n.startswith(f"{LOAD}=")]
    current = [n for n in loads if n not in left_out.get(month, ()) and (n in taken or not n.startswith(_MERGED))]
    if len(current) > 1:
        spec, merged = TABLES[table], f"{_MERGED}{uuid.uuid4().hex}"
        rows = spark.read.schema(spec.schema).parquet(*[f"{folder}/{LOAD}={n}" for n in current])
        ranged = rows.repartitionByRange(*spec.layout).sortWithinPartitions(*spec.layout)
        ranged.write.mode("overwrite").parquet(f"{folder}/{LOAD}={merged}")
        write_text(spark, f"{path}/{_MERGES}/{month}.{merged}", "\n".join(current))
        current = [merged]
    for name in loads:
        if name not in current:
            delete_folder(spark, f"{folder}/{LOAD}={name}")
    for name in files_in(spark, f"{path}/{_MERGES}"):
        number, _, merged = name.partition(".")
        if number == str(month) and not merged.endswith(_DONE):
            if merged in current:
                write_text(spark, f"{path}/{_MERGES}/{name}{_DONE}", "")
            else:
                delete_folder(spark, f"{path}/{_MERGES}/{name}")
                delete_folder(spark, f"{path}/{_MERGES}/{name}{_DONE}")


def _merges(spark: SparkSession, path: str) -> tuple[list[str], dict[int, list[str]]]:
    """Merged loads that count, and per month the loads that others stand for and that may still be there."""
    names = files_in(spark, f"{path}/{_MERGES}")
    marks = [n for n in names if not n.endswith((_DONE, ".draft"))]
    taken, left_out = [], {}
    for name in marks:
        month, _, merged = name.partition(".")
        taken.append(merged)
        if f"{name}{_DONE}" not in names:
            left_out.setdefault(int(month), []).extend(read_text(spark, f"{path}/{_MERGES}/{name}").split("\n"))
    return taken, left_out


def _current(spark: SparkSession, path: str) -> Column:
    """True for rows of loads that count: all but those that a merged one stands for, and merged ones not named yet."""
    taken, left_out = _merges(spark, path)
    counts = ~F.col(LOAD).startswith(_MERGED) | F.col(LOAD).isin(taken) if taken else ~F.col(LOAD).startswith(_MERGED)
    for month, loads in left_out.items():
        counts &= ~((F.col(MONTH) == month) & F.col(LOAD).isin(loads))
    return counts


def read_table(
    spark: SparkSession,
    base: str,
    table: str,
    start: str | dt.date | Column | None = None,
    end: str | dt.date | Column | None = None,
) -> DataFrame:
    """Rows whose exchange day is in [start, end].

    The month predicate is added here: a condition on the day alone prunes no folder.
    """
    spec = TABLES[table]
    folders = [T.StructField(MONTH, T.IntegerType()), T.StructField(LOAD, T.StringType())]
    rows = spark.read.schema(T.StructType([*spec.schema.fields, *folders])).parquet(table_path(base, table))
    rows = rows.filter(_current(spark, table_path(base, table)))
    column = F.col(spec.month_of)
    by_instant = isinstance(spec.type_of(spec.month_of), T.TimestampType)
    # Compared as stored, not as a day computed from it, so that file statistics can be used.
    if start is not None:
        first = F.lit(start).cast("date")
        from_here = column >= (exchange_midnight(first) if by_instant else first)
        rows = rows.filter((F.col(MONTH) >= month_number(first)) & from_here)
    if end is not None:
        last = F.lit(end).cast("date")
        beyond = F.date_add(last, 1)
        up_to = column < (exchange_midnight(beyond) if by_instant else beyond)
        rows = rows.filter((F.col(MONTH) <= month_number(last)) & up_to)
    return rows.select(*spec.columns)


def scan(
    df: DataFrame, table: str, key: str, start: str | dt.datetime, end: str | dt.datetime
) -> DataFrame:
    """Rows of one leading key in a time range [start, end), in layout order."""
    spec = TABLES[table]
    instant = F.col("timestamp")
    return df.filter(
        (F.col(spec.layout[0]) == F.lit(key))
        & (instant >= F.lit(start).cast("timestamp"))
        & (instant < F.lit(end).cast("timestamp"))
    ).orderBy(*spec.layout)


def _keep(spec: TableSpec, override_days: int | None) -> Column:
    return F.expr(f"INTERVAL {int(override_days)} DAYS" if override_days else spec.keep)


def retain(
    df: DataFrame,
    table: str,
    as_of: str | dt.date | dt.datetime,
    override_days: int | None = None,
) -> DataFrame:
    """Rows whose age is below the retention: base + interval > as_of.

    Adding the interval decides; the plain comparison beside it is implied by it and
    is what Parquet statistics can use.
    """
    spec = TABLES[table]
    base = F.col(spec.month_of)
    moment = F.lit(as_of).cast(spec.type_of(spec.month_of))
    keep = _keep(spec, override_days)
    return df.filter((base >= moment - keep) & (base + keep > moment))


def read_kept(
    spark: SparkSession,
    base: str,
    table: str,
    as_of: str | dt.date | dt.datetime,
    override_days: int | None = None,
) -> DataFrame:
    """The rows of a table that `retain` keeps, without opening months that hold none."""
    moment = exchange_clock(F.lit(as_of).cast("timestamp"))
    oldest = (moment - _keep(TABLES[table], override_days)).cast("date")
    rows = read_table(spark, base, table, start=F.date_sub(oldest, 1))
    return retain(rows, table, as_of, override_days)


def expire_months(
    spark: SparkSession,
    base: str,
    table: str,
    as_of: str | dt.date | dt.datetime,
    override_days: int | None = None,
) -> list[str]:
    """Delete the month folders that hold expired rows only; `retain` trims the border month."""
    spec = TABLES[table]
    moment = F.lit(as_of).cast("timestamp")
    border = spark.range(1).select(
        month_number(exchange_clock(moment) - _keep(spec, override_days))
    ).first()[0]
    path = table_path(base, table)
    expired = [
        name
        for name in subfolders(spark, path)
        if name.startswith(f"{MONTH}=") and int(name.split("=")[1]) < border
    ]
    for name in expired:
        delete_folder(spark, f"{path}/{name}")
    return expired
