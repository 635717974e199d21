"""Compares registered queries with their SQL in DuckDB, row by row."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(spark, con, build, sql: str, folder: str) -> str | None:
    """What differs, or None."""
    got = build(spark, folder)
    rows = got.collect()
    want = con.execute(sql)
    names = [c[0] for c in want.description]
    expected = want.fetchall()
    if sorted(names) != sorted(got.columns):
        return f"columns {sorted(got.columns)} != {sorted(names)}"
    ours, theirs = bag(got.columns, rows), bag(names, expected)
    if ours == theirs:
        return None
    extra, lacking = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
    return f"rows {len(rows)} != {len(expected)}; extra {extra}; lacking {lacking}"
