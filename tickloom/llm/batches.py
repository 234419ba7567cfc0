"""Shared plumbing: Arrow batches through a Python function, and tables kept in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tickloom.workspace import new_folder

BATCH_BYTES = 8 << 20


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that no column of the table has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def set_aside(df: DataFrame, names: set[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The table with columns of these names under other ones, and what puts its own columns back."""
    moved = {c: free_name(df, f"_own_{c}") for c in df.columns if c.lower() in names}

    def back(result: DataFrame) -> DataFrame:
        return result.select(*[F.col(f"`{moved.get(c, c)}`").alias(c) for c in df.columns])

    return df.withColumnsRenamed(moved), back


def small_batches(batches: Iterable[pa.RecordBatch], size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `size` bytes; one row may be longer."""
    for batch in batches:
        pieces = max(1, batch.nbytes // size)
        rows = max(1, -(-batch.num_rows // pieces))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def with_columns(
    df: DataFrame,
    added: str,
    work: Callable[[pa.RecordBatch], dict[str, object]],
    inputs: list[str],
    carry: list[str] | None = None,
    size: int = BATCH_BYTES,
) -> DataFrame:
    """Add columns that `work` makes from batches of the `inputs` columns.

    `carry` names the columns to keep beside the new ones (all unless given). A column of
    the table that has the name of a new one gives way to it.
    """
    new = T.StructType.fromDDL(added)
    names = {f.name.lower() for f in new}
    carry = [c for c in (df.columns if carry is None else carry) if c.lower() not in names]
    kept = [df.schema[c] for c in carry]
    schema = T.StructType([*kept, *new])
    fields = to_arrow_schema(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, size):
            made = work(batch.select(inputs))
            columns = [batch.column(c) for c in carry]
            for f in fields:
                v = made[f.name]
                columns.append(v if isinstance(v, pa.Array) else pa.array(v, f.type))
            yield pa.RecordBatch.from_arrays(columns, [*carry, *fields.names])

    return df.select(*dict.fromkeys([*carry, *inputs])).mapInArrow(run, schema)
