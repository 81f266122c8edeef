"""Runs a registered query and its SQL over the same tables and compares the results."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def compare(query, sql, spark, folder, con) -> str | None:
    """None when equal, else a description of the first difference."""
    df = query(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for mine, theirs in zip(got, want):
        if mine != theirs:
            return f"{sorted(names)}: {mine} != {theirs}"
    types = [type(v).__name__ for v in (got[0] if got else ())]
    wanted = [type(v).__name__ for v in (want[0] if want else ())]
    return None if types == wanted else f"types {types} != {wanted}"
