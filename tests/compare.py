"""Order-insensitive comparison of a Spark result with DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def cell(value: object) -> object:
    """A value in one form for both engines; types stay apart."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, float):
        return ("float", repr(value + 0.0 if value else 0.0))
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, (dt.date, dt.datetime)):
        return ("date", value.isoformat())
    return (type(value).__name__, value)


def normal(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def differences(spark_df, connection, sql: str) -> str | None:
    """None if both results are equal, else what differs."""
    found = [tuple(r) for r in spark_df.collect()]
    cursor = connection.execute(sql)
    columns, expected = [d[0] for d in cursor.description], cursor.fetchall()
    if sorted(spark_df.columns) != sorted(columns):
        return f"columns {sorted(spark_df.columns)} and {sorted(columns)}"
    if len(found) != len(expected):
        return f"{len(found)} rows, expected {len(expected)}"
    ours, theirs = normal(spark_df.columns, found), normal(columns, expected)
    if ours == theirs:
        return None
    only_ours = [r for r in ours if r not in set(theirs)][:3]
    only_theirs = [r for r in theirs if r not in set(ours)][:3]
    return f"{sorted(columns)}\n  spark {only_ours}\n  oracle {only_theirs}"
