"""Queries against their SQL in DuckDB."""

from __future__ import annotations

import os
from collections import Counter
from pathlib import Path

import duckdb

DATA = os.environ.get("INKWEIR_TESTDATA", "/root/testdata/sf0.001")


def connection(folder: str = DATA) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for f in Path(folder).glob("*.parquet"):
        c.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def differences(spark, query, sql: str, folder: str = DATA) -> tuple[Counter, Counter]:
    """Rows that only the query has, and rows that only the SQL has."""
    df = query(spark, folder)
    c = connection(folder)
    names = sorted(df.columns)
    assert sorted(c.sql(sql).columns) == names
    got = Counter(tuple(map(plain, r)) for r in df.select(*names).collect())
    want = Counter(tuple(map(plain, r)) for r in c.sql("SELECT " + ", ".join(f'"{n}"' for n in names) + f" FROM ({sql})").fetchall())
    return got - want, want - got
