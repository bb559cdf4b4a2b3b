"""Date and time functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def two_digit_year_date(col, pivot: int = 20) -> Column:
    """Date from ``m/d/yy`` text: yy > pivot -> 19yy, else 20yy; empty/NULL -> NULL.

    Spark's own ``yy`` pattern maps 68 to 2068, so the parts are split and rebuilt.
    """
    parts = F.split(_c(col), "/")
    m = F.element_at(parts, 1).try_cast("int")
    d = F.element_at(parts, 2).try_cast("int")
    yy = F.element_at(parts, 3).try_cast("int")
    y = F.when(yy > pivot, yy + 1900).otherwise(yy + 2000)
    text = F.concat_ws("-", y.cast("string"), F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0"))
    return F.when(F.trim(_c(col)) == "", F.lit(None).cast("date")).otherwise(F.try_to_date(text, "yyyy-MM-dd"))


def expand_year(col, this_year: int) -> Column:
    """Text ending in a two-digit year: yy < this_year -> insert '20', yy > this_year ->
    insert '19', equal -> unchanged (F10).

    ``this_year`` is the two-digit current year, passed in so results are stable.
    """
    c = _c(col)
    yy = F.right(c, F.lit(2)).try_cast("int")
    stem = F.left(c, F.length(c) - 2)
    century = F.when(yy < this_year, F.lit("20")).when(yy > this_year, F.lit("19"))
    return F.when(century.isNull(), c).otherwise(F.concat(stem, century, F.right(c, F.lit(2))))


def parse_file_time(col, fmt: str = "yyyy.MM.dd.HH.mm.ss") -> Column:
    """Timestamp (no time zone) parsed from a file-name pattern."""
    return F.to_timestamp_ntz(_c(col), F.lit(fmt))


def time_parts(col) -> list[Column]:
    """hour, month, year and day of week (1 = Sunday) of a timestamp."""
    c = _c(col)
    return [F.hour(c).alias("hour"), F.month(c).alias("month"), F.year(c).alias("year"),
            F.dayofweek(c).alias("dow")]


def weekday_name(col) -> Column:
    """Short weekday name, e.g. 'Mon' (F13)."""
    return F.date_format(_c(col), "E")


def trunc_ntz(col, unit: str) -> Column:
    """Truncate a TIMESTAMP_NTZ to the hour or day without a session time zone round
    trip (``date_trunc`` returns a zoned timestamp)."""
    c = _c(col)
    if unit == "day":
        return c.cast("date").cast("timestamp_ntz")
    if unit == "hour":
        return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0))
    raise ValueError(f"unsupported unit {unit}")
