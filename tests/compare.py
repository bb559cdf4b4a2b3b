"""Order-insensitive result comparison shared by the tests and tools/oracle_check.py."""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import math

import numpy as np


def norm(v):
    if v is None:
        return None
    if isinstance(v, (float, np.floating)):
        f = float(v)
        if math.isnan(f):
            return None
        r = round(f, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, decimal.Decimal):
        return norm(float(v))
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (int, np.integer)):
        return int(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(norm(r[i]) for i in order) for r in records)


def neg_zeros(records) -> int:
    """Count -0.0 values (a value hash would tell them from 0.0)."""
    def count(v):
        if isinstance(v, float):
            return int(v == 0 and math.copysign(1.0, v) < 0)
        if isinstance(v, (list, tuple, np.ndarray)):
            return sum(count(x) for x in v)
        return 0
    return sum(count(list(r)) for r in records)


def compare(scols, srecs, dcols, drecs) -> list[str]:
    problems = []
    if neg_zeros(srecs) != neg_zeros(drecs):
        problems.append(f"-0.0 counts differ: {neg_zeros(srecs)} vs {neg_zeros(drecs)}")
    if sorted(scols) != sorted(dcols):
        problems.append(f"columns differ: {sorted(scols)} vs {sorted(dcols)}")
    elif len(srecs) != len(drecs):
        problems.append(f"row counts differ: {len(srecs)} vs {len(drecs)}")
    else:
        a, b = rows_of(scols, srecs), rows_of(dcols, drecs)
        if a != b:
            problems.append(f"values differ: {list((a - b).elements())[:2]} vs {list((b - a).elements())[:2]}")
    return problems
