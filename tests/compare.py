"""Order-insensitive comparison of a Spark result with DuckDB's answer to the SQL twin."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, bool):
        return int(value)
    return value


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(lines, key=repr)


def differences(spark_df, connection, statement, limit=3):
    """Empty list when both sides agree in columns, row count and every value."""
    left_columns, left = normalised(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    answer = connection.execute(statement)
    right_columns, right = normalised([d[0] for d in answer.description], answer.fetchall())
    if left_columns != right_columns:
        return [f"columns {left_columns} against {right_columns}"]
    if len(left) != len(right):
        return [f"rows {len(left)} against {len(right)}"]
    found = [f"{a} against {b}" for a, b in zip(left, right) if a != b or repr(a) != repr(b)]
    return found[:limit]
