"""Compare registered queries with their SQL oracles."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def canonical(names, records) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in records)


def differences(frame, con, sql: str) -> str:
    """Empty when both sides have the same columns and rows."""
    result = con.sql(sql)
    if sorted(frame.columns) != sorted(result.columns):
        return f"columns {frame.columns} != {result.columns}"
    ours = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    theirs = canonical(result.columns, result.fetchall())
    if ours == theirs:
        return ""
    extra = sorted(set(ours) - set(theirs))[:3]
    missing = sorted(set(theirs) - set(ours))[:3]
    return f"{len(ours)} rows vs {len(theirs)}; only ours {extra}; only oracle {missing}"
