"""Profiling / EDA statistics.

Every summary is one aggregate over all requested columns (not one job per column).
Exact quantiles (pandas' linear interpolation) are read from positions in a
distributed sort of the unpivoted values, never from an exact-percentile buffer
that would gather a whole column into one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .aggregate import unpivot_wide
from .ordering import global_running_sum
from .project import select_by_type


def shape(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value) rows for numeric columns, NULLs dropped."""
    return (df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])).alias("kv"))
        .select("kv.*").filter(F.col("value").isNotNull() & ~F.isnan("value")))


def value_counts_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n): one row per distinct value of each column, counted with partial
    aggregation, so a value that most rows share is one row per task before the shuffle."""
    return long_values(df, cols).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def quantiles_of_counts(counts: DataFrame, qs: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles per column of (column, value, n) rows, exact.

    Position of q in N sorted values is h = (N-1) q; the result is
    v[floor h] + (h - floor h) (v[ceil h] - v[floor h]). A distinct value covers the positions
    between two running sums of counts along (column, value), a distributed sum.
    """
    run = global_running_sum(counts, ["column", "value"], ["n"])
    ends = run.groupBy("column").agg(F.max("n_cum").alias("_end"), F.min(F.col("n_cum") - F.col("n")).alias("_start"))
    placed = run.join(ends, "column").withColumn("_to", F.col("n_cum") - F.col("_start")) \
        .withColumn("_from", F.col("_to") - F.col("n"))
    total = F.col("_end") - F.col("_start")
    picks = F.array(*[F.struct(F.lit(float(q)).alias("q"), ((total - 1) * F.lit(float(q))).alias("h")) for q in qs])
    need = placed.select("column", "value", "_from", "_to", F.explode(picks).alias("p"))
    covers = lambda pos: (F.col("_from") <= pos) & (pos < F.col("_to"))
    lo, hi = F.floor("p.h"), F.ceil("p.h")
    agg = need.filter(covers(lo) | covers(hi)).groupBy("column", F.col("p.q").alias("q"), F.col("p.h").alias("h")).agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"))
    return agg.select("column", "q", (F.col("lo") + (F.col("h") - F.floor("h")) * (F.col("hi") - F.col("lo"))).alias("value"))


def exact_quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles per column (pandas/numpy default), exact, from value counts."""
    return quantiles_of_counts(value_counts_long(df, cols), qs)


def describe(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True,
             accuracy: int = 10_000, counts: DataFrame | None = None) -> DataFrame:
    """count, mean, std (sample), min, 25%, 50%, 75%, max per numeric column (E2), one
    row per column. ``exact=False`` takes the quartiles from ``percentile_approx`` in
    the same aggregate (rank error <= n / accuracy), avoiding the global sort. ``counts``:
    stored ``value_counts_long`` of these columns, when the caller has them."""
    cols = list(cols or select_by_type(df, ["numeric"]))
    long = long_values(df, cols)
    stats = [F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
             F.min("value").alias("min"), F.max("value").alias("max")]
    if not exact:
        qs = F.percentile_approx("value", [0.25, 0.5, 0.75], accuracy)
        out = long.groupBy("column").agg(*stats, qs.alias("_q"))
        return out.select("column", "count", "mean", "std", "min", F.col("_q")[0].alias("p25"),
                          F.col("_q")[1].alias("p50"), F.col("_q")[2].alias("p75"), "max")
    base = long.groupBy("column").agg(*stats)
    if counts is None:
        counts = value_counts_long(df, cols)  # a second scan
    q = quantiles_of_counts(counts, [0.25, 0.5, 0.75])
    qw = q.groupBy("column").pivot("q", [0.25, 0.5, 0.75]).agg(F.first("value"))
    qw = qw.toDF("column", "p25", "p50", "p75")
    return base.join(qw, "column").select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, unique, top, freq per string column (E3); top = most frequent, the
    smallest value on a tie."""
    long = (df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                          for c in cols])).alias("kv")).select("kv.*")
            .filter(F.col("value").isNotNull()))
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by(F.struct(F.col("value").alias("top"), F.col("n").alias("freq")),
                    F.struct((-F.col("n")).alias("n"), F.col("value").alias("v")))
    return counts.groupBy("column").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"),
                                        best.alias("b")).select("column", "count", "unique", "b.top", "b.freq")


def column_summary(df: DataFrame) -> DataFrame:
    """Per column: distinct count, type, missing % (E4, E16), one aggregate."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in df.columns:
        aggs += [F.countDistinct(F.col(c)).alias(f"{c}__u"), F.sum(F.col(c).isNull().cast("long")).alias(f"{c}__m")]
    r = df.agg(*aggs)
    types = dict(df.dtypes)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__u").alias("unique"),
                              F.lit(types[c]).alias("dtype"),
                              (F.col(f"{c}__m") * 100.0 / F.col("_n")).alias("missing_pct")) for c in df.columns])
    return r.select(F.explode(rows).alias("s")).select("s.*").orderBy(F.desc("missing_pct"), "column")


def text_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, value, n) of every column as text, NULLs dropped: one scan, one row per distinct value."""
    kinds = dict(df.dtypes)

    def text(c: str):  # -0.0 is the number 0.0
        return (F.col(c) + F.lit(0.0) if kinds[c] in ("double", "float") else F.col(c)).cast("string")

    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), text(c).alias("value"))
                                         for c in cols or df.columns])).alias("kv")).select("kv.*")
    return long.where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def profile_report(df: DataFrame, top: int = 5) -> DataFrame:
    """Full profile in the minimal form (E16): per column its type, distinct count, missing %,
    the numeric statistics of E2 (NULL for other types) and the ``top`` most frequent values.

    All columns are counted in one scan; distinct counts, missing % and top values come from these
    counts (a rank of at most ``top`` rows a column, limited before the shuffle).
    """
    numeric = select_by_type(df, ["numeric"])
    types = df.sparkSession.createDataFrame([(i, c, t) for i, (c, t) in enumerate(df.dtypes)],
                                            "_i int, column string, dtype string")
    total = df.count()
    counts = cut_lineage(text_counts(df))
    rank = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value"))
    best = counts.withColumn("_r", rank).where(F.col("_r") <= top)
    order = F.sort_array(F.collect_list(F.struct("_r", "value", "n")))  # ``top`` rows a column
    tops = best.groupBy("column").agg(F.transform(order, lambda x: F.struct(x["value"], x["n"])).alias("top_values"))
    whole = counts.groupBy("column").agg(F.count(F.lit(1)).alias("unique"), F.sum("n").alias("_n"))
    missing = F.try_divide((F.lit(total) - F.coalesce("_n", F.lit(0))) * 100.0, F.lit(total))
    rows = types.join(whole, "column", "left").select("column", F.coalesce("unique", F.lit(0)).alias("unique"), "dtype",
                                                      missing.alias("missing_pct"))
    return rows.join(describe(df, numeric), "column", "left").join(tops, "column", "left")


def data_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """E2 statistics plus NULL, zero and distinct counts per numeric column (E5).

    The value counts that give the quartiles also give the distinct counts.
    """
    cols = list(cols or select_by_type(df, ["numeric"]))
    counts = cut_lineage(value_counts_long(df, cols))
    aggs = []
    for c in cols:
        aggs += [F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}__nulls"),
                 F.count(F.when(F.col(c) == 0, 1)).alias(f"{c}__zeros")]
    extra = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__nulls").alias("nulls"),
                              F.col(f"{c}__zeros").alias("zeros")) for c in cols])
    extra = extra.select(F.explode(rows).alias("s")).select("s.*")
    unique = counts.groupBy("column").agg(F.count(F.lit(1)).alias("unique"))
    return (describe(df, cols, counts=counts).join(extra, "column").join(unique, "column"))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, long (a, b, corr).

    One scan: each task multiplies its batches to matrices of pairwise sums (counts, sums, squares and
    products over the rows that have both values) around the column means, and one set of sums a
    task is added up. NULL and NaN are missing; a column without variance has a NaN correlation.
    """
    cols, d = list(cols), len(cols)
    x = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)]
    values = df.select(*x)
    means = values.agg(*[F.avg(f"c{i}") for i in range(d)]).first()  # one row
    shift = np.array([0.0 if m is None else m for m in means])

    def sums(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros((4, d, d))
        for b in batches:
            m = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns])
            has = ~np.isnan(m)
            m = np.where(has, m - shift, 0.0)
            has = has.astype(float)
            total += np.stack([has.T @ has, m.T @ has, (m * m).T @ has, m.T @ m])
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["s"])

    parts = values.mapInArrow(sums, "s array<double>").select(F.posexplode("s").alias("i", "v"))
    found = np.zeros(4 * d * d)
    for r in parts.groupBy("i").agg(F.sum("v").alias("v")).collect():  # bounded by the number of columns
        found[r["i"]] = r["v"]
    n, s, q, p = found.reshape(4, d, d)
    with np.errstate(invalid="ignore", divide="ignore"):
        spread = q - s * s / n
        spread[spread <= n * (1e-12 * np.abs(shift)[:, None]) ** 2] = np.nan
        corr = np.where(n > 1, (p - s * s.T / n) / np.sqrt(spread * spread.T), np.nan)
    rows = [(a, b, None if n[i, j] < 2 else float(corr[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, corr double")


def histogram(df: DataFrame, col: str, bins: int, by: str | None = None) -> DataFrame:
    """k equal-width bins over [min, max]; the top edge falls in the last bin (numpy).
    The bounds are one aggregate row read as scalars; empty bins are zero rows from a
    k-row bin spine (per class with ``by``) (E7, E8). NULL and NaN are in no bin; without any
    other value all bins are empty, from 0 with width 1."""
    df = df.filter(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double")))
    st = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = (0.0, 0.0) if st["lo"] is None else (float(st["lo"]), float(st["hi"]))
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    keys = [by] if by else []
    counts = df.groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    if by:
        spine = df.select(by).distinct().select(by, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = spine.join(counts, [*keys, "bin"], "left").fillna(0, subset=["count"])
    return out.select(*keys, "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("left"),
                      (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("right"), "count")


def moments(df: DataFrame, col: str, by: str | None = None) -> DataFrame:
    """n, min, max, mean, sample variance, population skewness and excess kurtosis
    (scipy ``describe``) (E11)."""
    aggs = [F.count(col).alias("n"), F.min(col).alias("min"), F.max(col).alias("max"), F.avg(col).alias("mean"),
            F.var_samp(col).alias("variance"), F.skewness(col).alias("skewness"), F.kurtosis(col).alias("kurtosis")]
    return df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)


def compare_splits(a: DataFrame, b: DataFrame, cols: Sequence[str], names=("train", "test")) -> DataFrame:
    """Side-by-side count / mean / std of two splits per column, with the mean gap."""
    da = long_values(a, cols).groupBy("column").agg(
        F.count(F.lit(1)).alias(f"count_{names[0]}"), F.avg("value").alias(f"mean_{names[0]}"),
        F.stddev_samp("value").alias(f"std_{names[0]}"))
    db = long_values(b, cols).groupBy("column").agg(
        F.count(F.lit(1)).alias(f"count_{names[1]}"), F.avg("value").alias(f"mean_{names[1]}"),
        F.stddev_samp("value").alias(f"std_{names[1]}"))
    out = da.join(db, "column", "full")
    return out.withColumn("mean_diff", F.col(f"mean_{names[1]}") - F.col(f"mean_{names[0]}"))


def is_numeric(t: T.DataType) -> bool:
    return isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                          T.DecimalType))


__all__ = ["column_summary", "compare_splits", "corr_matrix", "data_summary", "describe", "describe_categorical",
           "exact_quantiles", "histogram", "moments", "shape", "unpivot_wide"]
