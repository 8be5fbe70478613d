"""Spark results against SQL results, as sets of rows with columns by name."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(folder: str, sql: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    return sorted_rows(columns, result.fetchall())


def difference(spark_result, duck_result) -> str | None:
    (names_a, rows_a), (names_b, rows_b) = spark_result, duck_result
    if names_a != names_b:
        return f"columns {names_a} != {names_b}"
    if len(rows_a) != len(rows_b):
        return f"rows {len(rows_a)} != {len(rows_b)}"
    for a, b in zip(rows_a, rows_b):
        if a != b:
            return f"first difference\n  {a!r:.600}\n  {b!r:.600}"
    return None
