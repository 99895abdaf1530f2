"""Comparison of a Spark result with the DuckDB result of its oracle."""

from __future__ import annotations

from decimal import Decimal
from pathlib import Path

import duckdb
import pyarrow as pa


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    """In-memory connection with a view per Parquet file of the folder."""
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _kind(field: pa.Field) -> str:
    kind = field.type
    if pa.types.is_integer(kind):
        return "integer"
    if pa.types.is_floating(kind):
        return "double"
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        return "string"
    return str(kind)


def _rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    return sorted(zip(*columns), key=repr)


def _same(a, b) -> bool:
    if isinstance(a, Decimal) or isinstance(b, Decimal):
        return a == b and str(a) == str(b)
    return a == b


def differences(spark_table: pa.Table, oracle_table: pa.Table, show: int = 3) -> list[str]:
    """What differs, in words; empty when schema and rows agree exactly."""
    found = []
    kinds = [
        {field.name: _kind(field) for field in table.schema}
        for table in (spark_table, oracle_table)
    ]
    if kinds[0] != kinds[1]:
        found.append(f"schema: {set(kinds[0].items()) ^ set(kinds[1].items())}")
        return found
    if spark_table.num_rows != oracle_table.num_rows:
        found.append(f"rows: {spark_table.num_rows} and {oracle_table.num_rows}")
    unequal = [
        (a, b)
        for a, b in zip(_rows(spark_table), _rows(oracle_table))
        if not all(map(_same, a, b))
    ]
    if unequal:
        found.append(f"values: {len(unequal)} rows differ, such as {unequal[:show]}")
    return found
