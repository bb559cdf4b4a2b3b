"""Math and hashing helpers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normal_pdf(x, mu, sd) -> Column:
    """Normal density at x."""
    xc, m, s = _c(x), _c(mu), _c(sd)
    return F.exp(-F.pow((xc - m) / s, 2) / 2.0) / (s * F.lit(math.sqrt(2 * math.pi)))


def fill_nan(col, value=0.0) -> Column:
    """NaN and NULL -> value (F31); ``value`` may be a literal or a Column."""
    v = value if isinstance(value, Column) else F.lit(value)
    return F.coalesce(F.nanvl(_c(col), F.lit(None).cast("double")), v)


def stable_bucket(key, n: int) -> Column:
    """Deterministic bucket 0..n-1 of a key from the first 8 hex digits of md5.

    The same value is computable in DuckDB, so split membership is oracle-checkable.
    """
    h = F.conv(F.substring(F.md5(_c(key).cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(h, F.lit(n))
