"""Comparison of a Spark result with DuckDB over the same tables."""

from __future__ import annotations

import contextlib
import io
import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _sortable(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, repr(v + 0.0))
    return (3, str(v))


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(r[i] for i in order) for r in rows], key=lambda r: tuple(map(_sortable, r)))


def assert_same(df, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    """Equal column names and equal multisets of rows; returns the row count."""
    wanted = con.execute(sql)
    names = [d[0] for d in wanted.description]
    assert sorted(df.columns) == sorted(names)
    expected = _rows(names, wanted.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    assert len(actual) == len(expected)
    differing = [(a, e) for a, e in zip(actual, expected) if a != e]
    assert not differing, differing[:3]
    return len(actual)


def plan_text(df) -> str:
    """The physical plan, in full."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
