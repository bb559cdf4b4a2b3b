"""Window and time-series operators.

Group-first operators (W1, W2) use partial aggregates (``min_by``), not a window
partitioned by the group key, so a key holding a third of the rows is combined per
task. Series operators (W5-W8) run on series that are already aggregated to a time
grid (one row per series and time step), in chunks with halo rows (``series_chunks``).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import normal_pdf
from .ordering import as_cols
from .series_chunks import CHUNK, DF_CONSTANT_CRIT, chunk_window, lagged_products, placed_series, with_halo


def split_first(df: DataFrame, key: str, order: Sequence[str], min_rows: int = 2):
    """First row of each group (target) and the remaining rows (features).

    NULL order values come last; rows that tie on ``order`` are ranked by all their other
    columns, so each group has one first row; rows equal in every column count as one row
    repeated, of which one is first. The first row is found with ``min_by`` (a partial
    aggregate), and both parts come from null-safe joins on the key and a hash of the whole
    row, which spread a hot key over many tasks. Groups with fewer than ``min_rows`` rows are
    dropped from the target; their only row is a first row and is not among the rest.
    """
    order = list(order)
    rest_cols = [c for c in df.columns if c not in (key, *order)]
    ranked = [x for c in [*order, *rest_cols] for x in (F.col(c).isNull(), F.col(c))]
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.withColumn("_h", F.xxhash64(*[x for c in df.columns for x in (F.col(c).isNull(), F.col(c))]))
    firsts = rows.groupBy(F.col(key).alias("_k")).agg(
        F.min_by("_h", F.struct(*ranked)).alias("_first"), F.sum("_n").alias("_rows"))
    at_first = F.col(key).eqNullSafe(F.col("_k")) & (F.col("_h") == F.col("_first"))
    target = rows.join(firsts.filter(F.col("_rows") >= min_rows), at_first, "left_semi").select(*df.columns)
    rest = rows.join(firsts.select("_k", "_first", F.lit(1).alias("_one")), at_first, "left")
    rest = rest.withColumn("_left", F.col("_n") - F.coalesce(F.col("_one"), F.lit(0))).filter("_left > 0")
    rest = rest.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_left").cast("int")))).select(*df.columns)
    if min_rows > 2:
        big = firsts.filter(F.col("_rows") >= min_rows).select("_k")
        rest = rest.join(big, F.col(key).eqNullSafe(F.col("_k")), "left_semi")
    return target, rest


def first_valid(df: DataFrame, key: str, col: str, order: Sequence[str], name: str | None = None) -> DataFrame:
    """First non-NULL value of ``col`` per group in ``order`` (W2), as a partial aggregate."""
    ordk = F.struct(*[F.col(c) for c in order])
    return (df.filter(F.col(col).isNotNull()).groupBy(key)
            .agg(F.min_by(F.col(col), ordk).alias(name or f"first_{col}")))


def sd_class(df: DataFrame, col: str, name: str = "segment") -> DataFrame:
    """Very Large / Large / Medium / Short by distance from the whole-table mean in
    sample standard deviations (W9). The two statistics are one aggregate row, read
    once and inlined as literals (no per-row recomputation, no cross join)."""
    st = df.agg(F.avg(col).alias("m"), F.stddev_samp(col).alias("s")).first()
    m, s = st["m"], st["s"]
    x = F.col(col)
    seg = (F.when(x > m + 3 * s, "Very Large")
           .when((x <= m + 3 * s) & (x > m + s), "Large")
           .when((x <= m + s) & (x >= m - s), "Medium")
           .when(x < m - s, "Short"))
    return df.withColumn(name, seg)


def normal_pdf_grid(df: DataFrame, col: str, points: int = 100) -> DataFrame:
    """Normal density on an even grid of ``points`` over mean +/- 3 sample sd.

    The grid is exploded from the one-row statistics on an executor.
    """
    st = df.agg(F.avg(col).alias("mu"), F.sqrt(F.var_samp(col)).alias("sigma"))
    lo = F.col("mu") - 3 * F.col("sigma")
    step = (6 * F.col("sigma")) / (points - 1)
    g = st.select("mu", "sigma", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    x = lo + F.col("i") * step
    return g.select("i", x.alias("x"), normal_pdf(x, "mu", "sigma").alias("pdf"))


def seasonal_decompose(df: DataFrame, ts: str, value: str, period: int, keys: Sequence[str] = (),
                       chunk: int = CHUNK) -> DataFrame:
    """Additive decomposition (W5): trend = centred moving average (for an even
    period the two end weights are halved), seasonal = mean of the detrended series
    per phase, re-centred to mean 0; resid = value - trend - seasonal. Trend and
    resid are NULL where the centred window does not fit. Windows run per chunk of a
    series with half a period of halo on both sides."""
    keys = list(keys)
    half = period // 2
    s = with_halo(placed_series(df, ts, value, keys), half, half, chunk)
    w = chunk_window(keys)
    x = F.col(value)
    total = F.sum(x).over(w.rowsBetween(-half, half))
    if period % 2 == 0:
        total = total - 0.5 * F.lag(x, half).over(w) - 0.5 * F.lead(x, half).over(w)
    fits = (F.col("idx") >= half) & (F.col("idx") + half <= F.col("n") - 1)
    # the halo rows' own windows are cut short; they are dropped here
    s = s.withColumn("trend", F.when(fits, total / period)).where("own").select(*keys, ts, "idx", value, "trend")
    s = s.withColumn("phase", F.col("idx") % period)
    detr = (x - F.col("trend"))
    phase = s.groupBy(*keys, "phase").agg(F.avg(detr).alias("_pa"))
    pw = Window.partitionBy(*keys)  # one row per phase
    phase = phase.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("phase").alias("_phase"),
                         (F.col("_pa") - F.avg("_pa").over(pw)).alias("seasonal"))
    cond = F.col("phase") == F.col("_phase")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    out = s.join(phase, cond, "left")
    return out.select(*keys, ts, "idx", value, "trend", "seasonal",
                      (x - F.col("trend") - F.col("seasonal")).alias("resid"))


def acf(df: DataFrame, ts: str, value: str, nlags: int, keys: Sequence[str] = (), chunk: int = CHUNK) -> DataFrame:
    """Autocorrelation for lags 0..nlags (W6): sum of lagged products of deviations over
    the total sum of squares, per series (``keys``). Products are summed per chunk, with
    ``nlags`` halo rows before it."""
    keys = list(keys)
    sums = lagged_products(placed_series(df, ts, value, keys), value, nlags, keys, chunk)
    zero = Window.partitionBy(*keys).orderBy("lag")  # nlags + 1 rows a series
    return sums.select(*keys, "lag", (F.col("num") / F.nullif(F.first("num").over(zero), F.lit(0.0))).alias("acf"))


def _durbin_levinson(pdf: pd.DataFrame) -> pd.DataFrame:
    r = pdf.sort_values("lag")["acf"].to_numpy()
    nl = len(r) - 1
    pac = np.zeros(nl + 1)
    pac[0] = 1.0
    phi = np.zeros(nl + 1)
    if nl >= 1:
        phi[1] = r[1]
        pac[1] = r[1]
        v = 1 - r[1] ** 2
        for k in range(2, nl + 1):
            prev = phi[1:k].copy()
            a = (r[k] - np.dot(prev, r[1:k][::-1])) / v
            phi[1:k] = prev - a * prev[::-1]
            phi[k] = a
            pac[k] = a
            v *= 1 - a * a
    out = pd.DataFrame({"lag": np.arange(nl + 1), "pacf": pac})
    for c in pdf.columns:
        if c not in ("lag", "acf"):
            out[c] = pdf[c].iloc[0]
    return out


def pacf(acf_df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Partial autocorrelation from the acf table by the Durbin-Levinson recursion
    (W7). One pandas group per series holding nlags+1 rows (bounded by nlags)."""
    keys = list(keys)
    if not keys:
        acf_df = acf_df.withColumn("_series", F.lit(0))
        keys_ = ["_series"]
    else:
        keys_ = keys
    schema = ", ".join(["lag long", "pacf double"] + [f"{k} {t}" for k, t in acf_df.select(*keys_).dtypes])
    out = acf_df.groupBy(*keys_).applyInPandas(_durbin_levinson, schema=schema)
    return out.drop("_series") if not keys else out


def adf_no_lag(df: DataFrame, ts: str, value: str, keys: Sequence[str] = (), chunk: int = CHUNK) -> DataFrame:
    """Dickey-Fuller test with a constant and no augmentation lags (W8):
    regress dy_t on y_{t-1}; statistic = slope / se(slope), from regression sums in
    one aggregate; critical values from MacKinnon's response surface at n. With lags:
    ``series_chunks.augmented_dickey_fuller``."""
    keys = list(keys)
    s = with_halo(placed_series(df, ts, value, keys), 1, 0, chunk)
    y, before = F.col(value), F.lag(value).over(chunk_window(keys))
    d = s.select(*keys, "own", (y - before).alias("dy"), before.alias("ylag")).where("own").drop("own").dropna(
        subset=["dy", "ylag"])
    agg = d.groupBy(*keys).agg(
        F.regr_count("dy", "ylag").alias("n"), F.regr_slope("dy", "ylag").alias("slope"),
        F.regr_sxx("dy", "ylag").alias("sxx"), F.regr_syy("dy", "ylag").alias("syy"),
        F.regr_sxy("dy", "ylag").alias("sxy"))
    ssr = F.col("syy") - F.col("slope") * F.col("sxy")
    se = F.sqrt(ssr / (F.col("n") - 2) / F.col("sxx"))
    n = F.col("n").cast("double")
    crit = {f"crit_{k.rstrip('%')}": b[0] + b[1] / n + b[2] / (n * n) + b[3] / (n * n * n)
            for k, b in DF_CONSTANT_CRIT.items()}
    return agg.select(*keys, "n", (F.col("slope") / se).alias("adf_stat"),
                      *[c.alias(k) for k, c in crit.items()])


def anomaly_flags(scored: DataFrame, score: str, train_cond: Column, factor: float = 1.05,
                  fixed: float | None = None) -> DataFrame:
    """Threshold = ``factor`` x max training score (or a fixed value); flag = score >
    threshold (W12). The max is one aggregate value, inlined as a literal."""
    if fixed is None:
        mx = scored.filter(train_cond).agg(F.max(score).alias("mx")).first()["mx"]
        thr = factor * mx
    else:
        thr = fixed
    return scored.select("*", F.lit(thr).alias("threshold"), (F.col(score) > F.lit(thr)).alias("anomaly"))


def class_share_by(df: DataFrame, part: Column | str, cls: str, name: str = "share") -> DataFrame:
    """Count and share of each class within each calendar part (W10); the share's
    denominator is a window over the already-aggregated (part, class) counts."""
    p = as_cols(part)
    counts = df.groupBy(*p, cls).agg(F.count(F.lit(1)).alias("n"))
    pname = [c for c in counts.columns if c not in (cls, "n")]
    return counts.select("*", (F.col("n") / F.sum("n").over(Window.partitionBy(*pname))).alias(name))
