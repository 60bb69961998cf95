"""Run a registered query beside its SQL twin and compare the rows."""

from __future__ import annotations

import glob
import os

import duckdb
import pyarrow as pa


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _kind(dtype: pa.DataType) -> str:
    if pa.types.is_timestamp(dtype):
        return "timestamp"
    if pa.types.is_large_string(dtype):
        return "string"
    return str(dtype)


def _rows(table: pa.Table) -> list[tuple]:
    columns = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in columns]
    return sorted((tuple(r) for r in zip(*data, strict=True)), key=repr)


def differences(spark_table: pa.Table, sql_table: pa.Table) -> str | None:
    """None if both hold the same columns, types and rows, else a description."""
    ours = {f.name: _kind(f.type) for f in spark_table.schema}
    theirs = {f.name: _kind(f.type) for f in sql_table.schema}
    if ours != theirs:
        keys = sorted(ours.keys() | theirs.keys())
        return "schema: " + str({k: (ours.get(k), theirs.get(k)) for k in keys if ours.get(k) != theirs.get(k)})
    if spark_table.num_rows != sql_table.num_rows:
        return f"rows: {spark_table.num_rows} against {sql_table.num_rows}"
    left, right = _rows(spark_table), _rows(sql_table)
    unequal = [(a, b) for a, b in zip(left, right, strict=True) if a != b]
    return f"{len(unequal)} rows differ, first: {unequal[0]}" if unequal else None
