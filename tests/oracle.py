"""Comparing Spark results with DuckDB results."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, type(v).__name__, str(v)) for v in row))


def compare(df, connection, sql):
    """None if both give the same rows and column names, else what differs."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _sorted_rows(names, cursor.fetchall())
    actual = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    different = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(different)} of {len(actual)} rows differ, first {different[0]}" if different else None
