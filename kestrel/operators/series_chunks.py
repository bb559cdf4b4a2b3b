"""One long series over many tasks: positions, chunks and halo rows.

A series is numbered along its time by a distributed row index and cut into chunks of ``CHUNK``
steps. A chunk also gets the rows that a window needs from its neighbours (its halo: copies of a
fixed number of rows before and behind it), so centred windows and lags run per chunk. Numbers
of a whole series (mean, length, sums of products) are partial aggregates over its chunks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import global_row_index

#: Steps of a chunk.
CHUNK = 1 << 16

# MacKinnon (2010) response-surface coefficients for the Dickey-Fuller
# test with a constant and one series (1%, 5%, 10%): crit = b0 + b1/n + b2/n^2 + b3/n^3.
DF_CONSTANT_CRIT = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}

# MacKinnon's (1994) approximation of the Dickey-Fuller p-value with a constant and one
# series: the normal distribution at a polynomial of the statistic, one below TAU_STAR and one above,
# 0 under TAU_MIN and 1 over TAU_MAX.
TAU_STAR, TAU_MIN, TAU_MAX = -1.61, -18.83, 2.74
SMALL_P = (2.1659, 1.4412, 0.038269)
LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)


def placed_series(df: DataFrame, ts: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, ts, value, idx, n, mean): 0-based step of each row in its series along ``ts``, the series'
    length and mean. Input: one row per series and time. No series is gathered into one task."""
    keys = list(keys)
    if not keys:
        placed = global_row_index(df.select(ts, value), [ts], "idx", total="n")
        mean = placed.agg(F.avg(value)).first()[0]  # one number
        return placed.select(ts, value, "idx", "n", F.lit(mean).cast("double").alias("mean"))
    placed = global_row_index(df.select(*keys, ts, value), [*keys, ts], "_at")
    # one row per series: joined by its key (AQE broadcasts it when small)
    whole = placed.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        F.min("_at").alias("_start"), F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"))
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return placed.join(whole, cond).select(*keys, ts, value, (F.col("_at") - F.col("_start")).alias("idx"), "n", "mean")


def with_halo(series: DataFrame, before: int, after: int, chunk: int = CHUNK) -> DataFrame:
    """Add ``chunk`` and ``own``: each row once in its own chunk, and as a copy in each chunk whose first
    step is at most ``before`` steps behind it or whose last step is at most ``after`` steps ahead of it."""
    size = F.lit(int(chunk)).cast("long")
    idx = F.col("idx")
    low = F.greatest(F.floor((idx - after) / size), F.lit(0)).cast("long")
    high = F.least(F.floor((idx + before) / size), F.floor((F.col("n") - 1) / size)).cast("long")
    return (series.withColumn("chunk", F.explode(F.sequence(low, high)))
            .withColumn("own", F.col("chunk") == F.floor(idx / size)))


def chunk_window(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys, "chunk").orderBy("idx")


def _key_schema(df: DataFrame, keys: Sequence[str]) -> str:
    return "".join(f"`{k}` {t}, " for k, t in df.select(*keys).dtypes)


def lagged_products(series: DataFrame, value: str, nlags: int, keys: Sequence[str], chunk: int = CHUNK) -> DataFrame:
    """(keys, lag, num): sums of products of deviations ``lag`` steps apart, for lags 0..nlags.

    Missing values (null or NaN) take no part. Lags without any product are left out.
    """
    keys = list(keys)
    halo = with_halo(series, nlags, 0, chunk).select(*keys, "chunk", "idx", "own",
                                                     (F.col(value) - F.col("mean")).alias("dev"))

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        own = int((~pdf["own"]).sum())  # the halo comes first
        dev = pdf["dev"].to_numpy(float)
        good = ~np.isnan(dev)
        dev = np.where(good, dev, 0.0)
        rows = []
        for lag in range(min(nlags, len(dev) - 1) + 1):
            lo = max(own, lag)
            if (good[lo:] & good[lo - lag:len(dev) - lag]).any():
                rows.append((lag, float(dev[lo:] @ dev[lo - lag:len(dev) - lag])))
        out = pd.DataFrame(rows, columns=["lag", "num"])
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out[[*keys, "lag", "num"]]

    parts = halo.groupBy(*keys, "chunk").applyInPandas(sums, f"{_key_schema(halo, keys)}lag int, num double")
    return parts.groupBy(*keys, "lag").agg(F.sum("num").alias("num"))


def default_lags(n: int) -> int:
    """Schwert's rule for the largest lag, at most what the length allows."""
    return max(0, min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2))


def p_value(stat: float) -> float:
    """MacKinnon's approximate p-value of a Dickey-Fuller statistic (constant, one series)."""
    if stat > TAU_MAX:
        return 1.0
    if stat < TAU_MIN:
        return 0.0
    z = sum(c * stat ** i for i, c in enumerate(SMALL_P if stat <= TAU_STAR else LARGE_P))
    return 0.5 * math.erfc(-z / math.sqrt(2))


def _design(y: np.ndarray, first: int, lags: int) -> np.ndarray:
    """Rows t = first.. of (1, y[t-1], dy[t-1], .., dy[t-lags], dy[t])."""
    dy = np.diff(y)  # dy[i] belongs to step i + 1
    t = np.arange(first, len(y))
    return np.column_stack([np.ones(len(t)), y[t - 1], *[dy[t - 1 - j] for j in range(1, lags + 1)], dy[t - 1]])


def _regression(gram: np.ndarray, rows: int) -> tuple[float, float]:
    """(t statistic of the second regressor, residual sum) from the Gram matrix; the last column is the target."""
    scale = np.sqrt(np.diag(gram))
    g = gram / np.outer(scale, scale)
    x, b = g[:-1, :-1], g[:-1, -1]
    beta = np.linalg.solve(x, b)
    rss = max(0.0, 1.0 - float(beta @ b)) * scale[-1] ** 2
    free = rows - len(beta)
    if rss <= 0 or free <= 0:
        return math.nan, rss
    # the regressor's scale cancels between its coefficient and its error
    error = math.sqrt(rss / free * float(np.linalg.inv(x)[1, 1]))
    return float(beta[1]) * scale[-1] / error, rss


def adf_from_sums(gram: np.ndarray, head: np.ndarray, n: int, lags: int, choose: bool) -> tuple:
    """(rows, lag, statistic) from the Gram matrix over steps lags + 1 .. n - 1 and the series' first steps.

    All nested regressions (0..lags lagged differences) are read off one Cholesky factor: with the
    target last, the squares of its last row are what each regressor takes off the residual sum.
    """
    rows = n - lags - 1
    try:
        scale = np.sqrt(np.diag(gram))
        if rows < 1 or not (scale > 0).all():
            return rows, None, None
        lag = lags
        if choose:
            low = np.linalg.cholesky(gram / np.outer(scale, scale))
            rss = (1 - np.cumsum(low[-1, :-1] ** 2)[1:]) * scale[-1] ** 2  # after regressors 1, 2, ..
            count = np.arange(2, lags + 3)
            aic = rows * (np.log(2 * np.pi) + np.log(rss / rows) + 1) + 2 * count
            lag = int(np.argmin(aic))
        keep = [0, 1, *range(2, 2 + lag), len(gram) - 1]
        own = gram[np.ix_(keep, keep)]
        more = _design(head[:lags + 1], lag + 1, lag) if lag < lags else np.zeros((0, lag + 3))
        stat, _ = _regression(own + more.T @ more, rows + len(more))
    except np.linalg.LinAlgError:
        return rows, None, None
    return (rows + len(more), lag, stat) if math.isfinite(stat) else (rows + len(more), lag, None)


def augmented_dickey_fuller(df: DataFrame, ts: str, value: str, keys: Sequence[str] = (), max_lag: int | None = None,
                            choose: bool = True, chunk: int = CHUNK) -> DataFrame:
    """Augmented Dickey-Fuller test with a constant (W8): (keys, n, lag, adf_stat, p_value, crit_1, crit_5, crit_10).

    Regresses each step's difference on the level before it and ``lag`` earlier differences; the lag
    has the least AIC of 0..max_lag on the steps that all of them have, and is then fitted on all its
    own steps. ``max_lag`` is Schwert's rule by default, and at most half of the series less 2; with
    ``choose=False`` it is the lag. Every chunk adds one Gram matrix of its lagged differences; a series is solved from their sum.
    Series with missing values, or that are constant or too short, get a null statistic.
    """
    keys = list(keys)
    placed = placed_series(df, ts, value, keys)
    if max_lag is None:
        longest = placed.agg(F.max("n").alias("n")).first()["n"]
        widest = default_lags(longest or 0)
    else:
        widest = max_lag
    chunk = max(chunk, widest + 2)
    halo = with_halo(placed, widest + 1, 0, chunk).select(*keys, "chunk", "idx", "own", "n",
                                                          (F.col(value) - F.col("mean")).alias("y"))

    def lags_of(n: int) -> int:
        return default_lags(n) if max_lag is None else max(0, min(max_lag, n // 2 - 2))

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        n, start, y = int(pdf["n"].iloc[0]), int(pdf["idx"].iloc[0]), pdf["y"].to_numpy(float)
        lags = lags_of(n)
        first = max(int((~pdf["own"]).sum()), lags + 1 - start)
        z = _design(y, first, lags) if first < len(y) else np.zeros((0, lags + 3))
        out = pd.DataFrame({"n": [n], "gram": [(z.T @ z).ravel().tolist()],
                            "head": [y[:lags + 1].tolist() if start == 0 else None]})
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out[[*keys, "n", "gram", "head"]]

    typed = _key_schema(halo, keys)
    parts = halo.groupBy(*keys, "chunk").applyInPandas(part, f"{typed}n long, gram array<double>, head array<double>")
    summed = (parts.select(*keys, "n", F.posexplode("gram").alias("i", "g")).groupBy(*keys, "n", "i")
              .agg(F.sum("g").alias("g")).groupBy(*keys, "n")
              .agg(F.sort_array(F.collect_list(F.struct("i", "g"))).alias("s")))
    heads = parts.where("head is not null").select(*[F.col(k).alias(f"_k_{k}") for k in keys], "head")
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    whole = summed.join(heads, cond).select(*keys, "n", F.col("s.g").alias("gram"), "head")

    def solve(batches):
        for pdf in batches:
            rows = []
            for n, gram, head in zip(pdf["n"], pdf["gram"], pdf["head"], strict=True):
                g = np.array(gram, float)
                g = g.reshape(math.isqrt(len(g)), -1)
                used, lag, stat = adf_from_sums(g, np.array(head, float), int(n), len(g) - 3, choose) \
                    if np.isfinite(g).all() else (0, None, None)
                rows.append((used, lag, stat, None if stat is None else p_value(stat)))
            out = pdf[keys].copy()
            for i, c in enumerate(("n", "lag", "adf_stat", "p_value")):
                out[c] = pd.Series([r[i] for r in rows], index=out.index, dtype=object)
            yield out

    solved = whole.mapInPandas(solve, f"{typed}n long, lag int, adf_stat double, p_value double")
    n = F.nullif(F.col("n"), F.lit(0)).cast("double")
    crit = [(b[0] + b[1] / n + b[2] / (n * n) + b[3] / (n * n * n)).alias(f"crit_{k.rstrip('%')}")
            for k, b in DF_CONSTANT_CRIT.items()]
    return solved.select("*", *crit)
