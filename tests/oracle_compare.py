"""Order-insensitive comparison of a Spark result and a DuckDB result (pandas frames)."""

from __future__ import annotations

import datetime as dt
import math

import pandas as pd


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return round(float(v), 6)
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.date() if v == v.normalize() else v.to_pydatetime()
    if isinstance(v, dt.datetime) and v.time() == dt.time(0):
        return v.date()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def canonical_rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(v) for v in r) for r in df[cols].astype(object).itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare_frames(a: pd.DataFrame, b: pd.DataFrame) -> tuple[bool, str]:
    if sorted(a.columns) != sorted(b.columns):
        return False, f"columns differ: {sorted(a.columns)} vs {sorted(b.columns)}"
    if len(a) != len(b):
        return False, f"row count {len(a)} vs {len(b)}"
    ra, rb = canonical_rows(a), canonical_rows(b)
    for x, y in zip(ra, rb):
        if x != y:
            return False, f"first diff: {x} vs {y}"
    return True, ""
