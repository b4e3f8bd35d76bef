"""Compare a Spark frame with the same query run by the oracle database."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None:
        return None
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()[:10] if not hasattr(value, "hour") else value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return _rows([c.lower() for c in df.columns], [tuple(r) for r in df.collect()])


def oracle_rows(con, sql: str):
    cursor = con.execute(sql)
    names = [d[0].lower() for d in cursor.description]
    return _rows(names, cursor.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None when both sides agree exactly, else a short description."""
    left, right = spark_rows(df), oracle_rows(con, sql)
    if left[0] != right[0]:
        return f"columns {sorted(set(left[0]) ^ set(right[0]))}"
    if len(left[1]) != len(right[1]):
        return f"rows {len(left[1])} != {len(right[1])}"
    if left[1] == right[1] and [tuple(map(type, r)) for r in left[1][:50]] == [tuple(map(type, r)) for r in right[1][:50]]:
        return None
    wrong = {}
    for a, b in zip(left[1], right[1]):
        for name, x, y in zip(left[0], a, b):
            if x != y or type(x) is not type(y):
                wrong.setdefault(name, []).append((x, y))
    return "; ".join(f"{n}: {len(v)} e.g. {v[:3]}" for n, v in list(wrong.items())[:12]) or "types differ"
