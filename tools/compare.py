"""Order-insensitive comparison of two result tables (Spark vs DuckDB)."""

from __future__ import annotations

import datetime
import math

import numpy as np
import pandas as pd


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, (np.floating,)):
        return None if np.isnan(v) else float(v)
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (np.bool_,)):
        return bool(v)
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime()
    if isinstance(v, datetime.datetime):
        return v.date() if v.time() == datetime.time(0) else v
    if isinstance(v, np.ndarray):
        return tuple(_norm(x) for x in v)
    if isinstance(v, list):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, str(type(x).__name__ == "float" and round(x, 6) or x)) for x in row)


def rows(df: pd.DataFrame, cols):
    out = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    out.sort(key=_key)
    return out


def close(a, b, rel=1e-9):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        try:
            fa, fb = float(a), float(b)
        except (TypeError, ValueError):
            return False
        return fa == fb or abs(fa - fb) <= rel * max(1.0, abs(fa), abs(fb))
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(close(x, y, rel) for x, y in zip(a, b))
    if hasattr(a, "isoformat") and hasattr(b, "isoformat"):
        return str(a)[:10] == str(b)[:10] if len(str(a)) <= 10 or len(str(b)) <= 10 else a == b
    return a == b



def _printed(r):
    """Printed form of a row; integral floats print as ints (a nullable bigint
    column arrives as float64 from Spark and Int64 from DuckDB), so only
    real differences such as -0.0 vs 0.0 remain."""
    return tuple(repr(int(v)) if isinstance(v, float) and v.is_integer() and str(v) != "-0.0" else repr(v)
                 for v in r)


def compare(sp: pd.DataFrame, dd: pd.DataFrame, rel: float = 1e-9) -> tuple[bool, bool, str]:
    """(match, exact, message) for two pandas frames with the same column names."""
    sc, dc = sorted(sp.columns), sorted(dd.columns)
    if sc != dc:
        return False, False, f"columns differ: {sc} vs {dc}"
    if len(sp) != len(dd):
        return False, False, f"rows differ: {len(sp)} vs {len(dd)}"
    rs, rd = rows(sp, sc), rows(dd, sc)
    if rs == rd:
        # exact also means the same printed form (catches -0.0 vs 0.0, 1 vs 1.0)
        same_repr = [_printed(r) for r in rs] == [_printed(r) for r in rd]
        return True, same_repr, "" if same_repr else "values equal but printed forms differ"
    for ra, rb in zip(rs, rd):
        if not all(close(a, b, rel) for a, b in zip(ra, rb)):
            return False, False, f"first differing row: {sc}\n  {ra}\n  {rb}"
    return True, False, ""
