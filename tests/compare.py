"""Compares a Spark result with its SQL counterpart: names, row count and values."""

from __future__ import annotations

import datetime
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else round(number, 9) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return names, sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(df, connection, sql: str) -> str | None:
    """None if equal, else a short description of the first difference."""
    names, left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    other_names, right = rows_of([d[0] for d in result.description], result.fetchall())
    if names != other_names:
        return f"columns {names} / {other_names}"
    if len(left) != len(right):
        return f"{len(left)} rows / {len(right)} rows"
    wrong = [(a, b) for a, b in zip(left, right, strict=True) if a != b]
    if wrong:
        a, b = wrong[0]
        fields = [(n, str(x)[:80], str(y)[:80]) for n, x, y in zip(names, a, b, strict=True) if x != y]
        return f"{len(wrong)} of {len(left)} rows differ, first: {fields}"
    return None
