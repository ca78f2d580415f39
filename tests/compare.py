"""Compare a Spark result with the result of SQL in DuckDB, regardless of row order."""

from __future__ import annotations

import datetime
import decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        if Path(f"{folder}/{table}.parquet").exists():
            connection.execute(
                f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
            )
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, datetime.datetime):
        return ("timestamp", value.replace(tzinfo=None).isoformat())
    if isinstance(value, datetime.date):
        return ("date", value.isoformat())
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, float):
        return ("float", repr(value))
    return (type(value).__name__, value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


def difference(df, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both agree in columns, types of values and values."""
    relation = connection.execute(sql)
    want_columns, want = _rows([d[0] for d in relation.description], relation.fetchall())
    got_columns, got = _rows(df.columns, df.collect())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    different = [(g, w) for g, w in zip(got, want) if g != w]
    if different:
        return f"{len(different)} of {len(got)} rows differ, first {different[0]}"
    return None
