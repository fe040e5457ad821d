"""Compare a registered query with its oracle SQL on the same Parquet tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]
    rows = []
    for row in pdf.itertuples(index=False, name=None):
        rows.append(tuple(_cell(v) for v in row))
    return sorted(rows, key=repr)


def _cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, pd.Timestamp):
        return v.isoformat()
    if hasattr(v, "item"):
        v = v.item()
    return v


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None if both frames hold the same rows, else a short description."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    if len(a) != len(b):
        return f"{len(a)} rows, expected {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        cols = sorted(got.columns)
        x, y = bad[0]
        diff = {c: (p, q) for c, p, q in zip(cols, x, y) if p != q}
        return f"{len(bad)} of {len(a)} rows differ, first: {diff}"
    return None
