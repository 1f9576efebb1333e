"""Order-insensitive comparison of a Spark result with DuckDB's on the same tables."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _cell(value) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (float, decimal.Decimal)):
        return f"{float(value):.6g}" if abs(float(value)) >= 1e9 else f"{float(value):.4f}"
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(_cell, value)) + "]"
    return str(value)


def canonical(names: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(frame, connection, sql: str) -> str | None:
    """None if equal, else what differs."""
    got = canonical(frame.columns, frame.collect())
    answer = connection.sql(sql)
    want = canonical(answer.columns, answer.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    for a, b in zip(got[1], want[1]):
        if a != b:
            return f"row {a} != {b}"
    return None
