"""Run registered queries in Spark and their SQL twins in DuckDB, and compare all values."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import numpy as np
import pandas as pd


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(folder, "*.parquet")):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return (0, "")
    if isinstance(value, (bool, np.bool_)):
        return (1, bool(value))
    if isinstance(value, (int, np.integer)):
        return (2, float(value))
    if isinstance(value, (float, np.floating)):
        return (0, "") if math.isnan(value) else (2, float(value))
    if isinstance(value, pd.Timestamp):
        return (3, value.tz_localize(None) if value.tzinfo else value)
    return (4, str(value))


def _rows(pdf: pd.DataFrame, columns: list[str]) -> list[tuple]:
    cells = [[_cell(v) for v in pdf[c].astype(object).tolist()] for c in columns]
    return sorted(zip(*cells), key=lambda r: tuple((k, str(v) if k != 2 else "", v if k == 2 else 0) for k, v in r))


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when equal (floats exactly), else a short account."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    columns = sorted(got.columns)
    left, right = _rows(got, columns), _rows(want, columns)
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if not bad:
        return None
    close = all(
        x == y or (x[0] == y[0] == 2 and math.isclose(x[1], y[1], rel_tol=1e-9, abs_tol=1e-9))
        for a, b in bad for x, y in zip(a, b))
    return f"{len(bad)} rows differ{' in the last digits' if close else ''}: {columns} {bad[0]}"
