"""Grouped counts, sums, shares, distinct counts, mode and rate tables.

Every aggregate here is a plain ``groupBy().agg`` so Spark runs a partial
(map-side) aggregate before the shuffle: a key holding a third of the rows is
pre-combined in every task and never reaches one reducer as raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import as_cols


def group_count(df: DataFrame, keys, name: str = "cnt") -> DataFrame:
    """``SELECT keys, COUNT(*) AS cnt GROUP BY keys`` (A1)."""
    return df.groupBy(*as_cols(keys)).agg(F.count(F.lit(1)).alias(name))


def top_n(df: DataFrame, key, n: int, by: Column | str | None = None,
          name: str = "cnt") -> DataFrame:
    """Top-n keys by count (or by the sum of ``by``), key as the tie-break (L1, L2).

    ``orderBy(...).limit(n)`` becomes TakeOrderedAndProject: each task keeps an
    n-row heap, so only n rows per task cross the network.
    """
    keys = as_cols(key)
    if by is None:
        agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    else:
        agg = df.groupBy(*keys).agg(F.sum(by).alias(name))
    return agg.orderBy(F.col(name).desc(), *[k.asc() for k in keys]).limit(n)


def keep_top_n(df: DataFrame, key: str, n: int, by=None) -> DataFrame:
    """Keep rows whose ``key`` is among the top-n by count (IN-subquery, J1).

    The top-n list has at most ``n`` rows, so it is broadcast into a left-semi join.
    """
    top = top_n(df, key, n, by).select(key)
    return df.join(F.broadcast(top), on=key, how="left_semi")


def value_counts(df: DataFrame, col: str, normalize: bool = False,
                 name: str | None = None) -> DataFrame:
    """Value counts, the most frequent first (A2), or shares of the total (A3).

    The share divides by the grand total, one number read from an aggregate and
    inlined, so a column with many distinct values never meets in one task.
    """
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        total = df.agg(F.count(F.lit(1)).alias("n")).first()["n"]
        return out.select(col, (F.col("count") / F.lit(total)).alias(name or "share"))
    return out.orderBy(F.desc("count"), col)


def group_sums(df: DataFrame, keys, values: dict[str, Column | str], how: str = "sum") -> DataFrame:
    """Several sums (or avg/min/max) per group in one aggregate."""
    fn = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}[how]
    return df.groupBy(*as_cols(keys)).agg(*[fn(v).alias(k) for k, v in values.items()])


def flag_rate(df: DataFrame, bucket, flag: str) -> DataFrame:
    """Sum, count and mean of a 0/1 flag per bucket: the bad rate."""
    return df.groupBy(*as_cols(bucket)).agg(
        F.sum(F.col(flag).cast("long")).alias("n_flag"),
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(flag).cast("double")).alias("rate"))


def quarter_end(col: Column | str) -> Column:
    """Last day of the calendar quarter of a date/timestamp."""
    c = F.col(col) if isinstance(col, str) else col
    return F.last_day(F.add_months(F.trunc(c.cast("date"), "quarter"), 2))


def period_rate(df: DataFrame, date_col: str, flag: str) -> DataFrame:
    """Quarterly sum and count of a flag, labelled by quarter end, with empty
    quarters inside the range as zero rows (A9).

    The quarter spine is exploded from the data's min/max date: one row per quarter
    in the range, so the planner broadcasts it into the left join.
    """
    from ..sources.spine import calendar_spine
    q = df.select(quarter_end(date_col).alias("quarter_end"), F.col(flag).cast("long").alias("_f"))
    agg = q.groupBy("quarter_end").agg(F.sum("_f").alias("n_flag"), F.count(F.lit(1)).alias("n"))
    bounds = q.agg(F.min("quarter_end").alias("lo"), F.max("quarter_end").alias("hi"))
    spine = calendar_spine(bounds, "lo", "hi", step="3 months", name="quarter_end",
                           month_end=True)
    return (spine.join(agg, "quarter_end", "left")
            .select("quarter_end", F.coalesce("n_flag", F.lit(0)).alias("n_flag"),
                    F.coalesce("n", F.lit(0)).alias("n")))


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of a column, sorted (A10)."""
    return df.select(col).distinct().orderBy(col)


def nunique_all(df: DataFrame, cols=None, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Exact distinct count of every column in ONE aggregate, long form.

    One job for all columns, not a job per column; nulls are not counted (as pandas).
    Exact counts of several columns expand each row once per column before the
    shuffle; ``approx=True`` uses HyperLogLog++ sketches instead (relative error
    ``rsd``), which merge map-side and need no expansion.
    """
    cols = cols or df.columns
    fn = (lambda c: F.approx_count_distinct(F.col(c), rsd)) if approx else (lambda c: F.countDistinct(F.col(c)))
    wide = df.agg(*[fn(c).alias(c) for c in cols])
    return unpivot_wide(wide, cols, "column", "nunique")


def distinct_pairs(df: DataFrame, a: str, b: str, name: str = "n_pairs") -> DataFrame:
    """Count distinct (a, b) tuples; a pair holding a null still counts."""
    return df.agg(F.countDistinct(F.struct(F.col(a), F.col(b))).alias(name))


def null_share(df: DataFrame, cols=None) -> DataFrame:
    """Null count and share of every column, one aggregate, long form."""
    cols = cols or df.columns
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        aggs.append(F.sum(F.col(c).isNull().cast("long")).alias(c))
    wide = df.agg(*aggs)
    long = unpivot_wide(wide, cols, "column", "n_null", keep=["_n"])
    return long.select("column", "n_null", (F.col("n_null") / F.col("_n")).alias("null_share"))


def mean_abs(df: DataFrame, keys, cols, suffix: str = "") -> DataFrame:
    """Mean of absolute values of several channels per group."""
    return df.groupBy(*as_cols(keys)).agg(*[F.avg(F.abs(F.col(c))).alias(f"{c}{suffix}") for c in cols])


def min_max(df: DataFrame, cols) -> DataFrame:
    """Per-column min and max; Spark's partial+final aggregate is the chunked fit.

    ``+ 0.0`` turns a -0.0 extreme into 0.0: min/max of equal zeros depends on row
    order, and the sign would otherwise differ between runs and engines."""
    aggs = []
    for c in cols:
        aggs += [(F.min(c) + 0.0).alias(f"{c}_min"), (F.max(c) + 0.0).alias(f"{c}_max")]
    return df.agg(*aggs)


def score_stats(df: DataFrame, col: str, by=None) -> DataFrame:
    """Max, mean, sample variance of a score."""
    aggs = [F.max(col).alias("max"), F.avg(col).alias("mean"), F.var_samp(col).alias("var")]
    return df.groupBy(*as_cols(by)).agg(*aggs) if by else df.agg(*aggs)


def mode_value(df: DataFrame, col: str, by=None) -> DataFrame:
    """Most frequent value, smallest wins a tie (A19; pandas ``mode()[0]``)."""
    keys = as_cols(by) if by else []
    counted = df.filter(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_c"))
    # min_by over (-count, value): the largest count first, then the smallest value
    best = F.min_by(F.col(col), F.struct((-F.col("_c")).alias("c"), F.col(col).alias("v")))
    return counted.groupBy(*keys).agg(best.alias("mode"))


def unpivot_wide(wide: DataFrame, cols, name_col: str, value_col: str, keep=()) -> DataFrame:
    """Wide one-row-per-group statistics to long (name, value) rows."""
    ids = [c for c in keep]
    return wide.unpivot(ids, list(cols), name_col, value_col)
