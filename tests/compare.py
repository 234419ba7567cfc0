"""Compare a Spark result with DuckDB's: columns, types, rows, values."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pyarrow as pa


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain_type(t: pa.DataType) -> str:
    if pa.types.is_large_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return f"timestamp tz={t.tz}"
    return str(t)


def _rows(table: pa.Table, names: list[str]) -> list[tuple]:
    rows = zip(*[table.column(n).to_pylist() for n in names])
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    ours = spark_df.toArrow()
    theirs = con.execute(sql).to_arrow_table()
    found = []
    names = sorted(ours.schema.names)
    if names != sorted(theirs.schema.names):
        return [f"columns {names} / {sorted(theirs.schema.names)}"]
    for n in names:
        a, b = _plain_type(ours.schema.field(n).type), _plain_type(theirs.schema.field(n).type)
        if a != b:
            found.append(f"type of {n}: {a} / {b}")
    if ours.num_rows != theirs.num_rows:
        found.append(f"rows {ours.num_rows} / {theirs.num_rows}")
    left, right = _rows(ours, names), _rows(theirs, names)
    wrong = [
        (x, y) for x, y in zip(left, right) if not all(_same(a, b) for a, b in zip(x, y))
    ]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first: {wrong[0]}")
    if not left:
        found.append("no rows")
    return found
