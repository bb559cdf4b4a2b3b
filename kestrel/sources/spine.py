"""Rows made from a range rather than read: calendar spines.

The range comes from data (a one-row bounds frame), and the spine rows are made on
the executors with ``sequence`` + ``explode``; nothing is built in the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def calendar_spine(bounds: DataFrame, lo: str, hi: str, step: str = "1 day",
                   name: str = "day", month_end: bool = False) -> DataFrame:
    """One row per step from ``bounds[lo]`` to ``bounds[hi]`` inclusive.

    ``month_end`` snaps every element to the last day of its month (quarter-end
    labels stay month ends when stepping by months).
    """
    seq = F.sequence(F.col(lo).cast("date"), F.col(hi).cast("date"), F.expr(f"INTERVAL {step}"))
    out = bounds.select(F.explode(seq).alias(name))
    if month_end:
        out = out.select(F.last_day(name).alias(name))
    return out


def date_bounds(df: DataFrame, col: str) -> DataFrame:
    """One-row frame with the min and max date of a column."""
    return df.agg(F.min(F.col(col).cast("date")).alias("lo"), F.max(F.col(col).cast("date")).alias("hi"))


def calendar_spine_between(spark, start: str, end: str, step: str = "1 day", name: str = "day") -> DataFrame:
    """Calendar rows between two literal dates (S15), made on an executor."""
    bounds = spark.range(1).select(F.lit(start).cast("date").alias("lo"), F.lit(end).cast("date").alias("hi"))
    return calendar_spine(bounds, "lo", "hi", step, name)
