"""Compare a registered query with its SQL twin."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal
from pathlib import Path

import duckdb

GIVEN_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in GIVEN_TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value: object) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, dt.datetime) and value.time() == dt.time():
        return value.date().isoformat()
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, Decimal):
        return f"{float(value):.9g}"
    return str(value)


def rows(columns: list[str], data: list) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in data)


def difference(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    result = connection.execute(sql)
    expected_columns = [c[0] for c in result.description]
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} vs {sorted(expected_columns)}"
    expected = rows(expected_columns, result.fetchall())
    actual = rows(df.columns, df.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows vs {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
