"""One series over many chunks equals numpy on the whole series; augmented Dickey-Fuller equals least squares."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators.series_chunks import (augmented_dickey_fuller, default_lags, lagged_products, p_value,
                                             placed_series, with_halo)
from kestrel.operators.timeseries import acf, adf_no_lag, seasonal_decompose


@pytest.fixture(scope="module")
def walks():
    rng = np.random.default_rng(6)
    ar = np.zeros(700)
    for i in range(2, 700):
        ar[i] = 0.5 * ar[i - 1] - 0.4 * ar[i - 2] + rng.normal()
    return {"ar": ar + 40, "walk": np.cumsum(rng.normal(size=700)) + 1000, "short": rng.normal(size=13),
            None: np.cumsum(rng.normal(size=250))}


@pytest.fixture(scope="module")
def rows(spark, walks):
    made = [(k, t, float(x)) for k, v in walks.items() for t, x in enumerate(v)]
    return spark.createDataFrame(made, "k string, t long, v double").repartition(5).cache()


def test_positions_and_halo(spark, rows, walks):
    placed = placed_series(rows, "t", "v", ["k"])
    assert placed.where("idx <> t").count() == 0
    assert {r["k"]: r["n"] for r in placed.groupBy("k").agg(F.max("n").alias("n")).collect()} == {
        k: len(v) for k, v in walks.items()}
    halo = with_halo(placed, 7, 3, 50)
    for r in halo.groupBy("k", "chunk").agg(F.min("idx").alias("lo"), F.max("idx").alias("hi"), F.max("n").alias("n"),
                                            F.count("*").alias("rows"), F.sum(F.col("own").cast("int")).alias("own")).collect():
        lo, hi = max(0, r["chunk"] * 50 - 7), min(r["n"], (r["chunk"] + 1) * 50 + 3) - 1
        assert (r["lo"], r["hi"], r["rows"]) == (lo, hi, hi - lo + 1)
        assert r["own"] == min(50, r["n"] - r["chunk"] * 50)


def test_a_series_lies_in_many_tasks(rows):
    one = placed_series(rows.where("k = 'ar'"), "t", "v")
    parts = with_halo(one, 10, 10, 20).repartition(4, "chunk").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1 and max(p["count"] for p in parts) < 700


@pytest.mark.parametrize("period,chunk", [(4, 1), (4, 37), (4, 10_000), (7, 64)])
def test_decomposition_in_chunks(rows, walks, period, chunk):
    got = seasonal_decompose(rows.where("k in ('ar', 'walk') or k is null"), "t", "v", period, ["k"], chunk).toPandas()
    for k in ("ar", "walk", None):
        v = walks[k]
        part = got[got["k"].isna() if k is None else got["k"] == k].sort_values("idx")
        w = np.r_[0.5, np.ones(period - 1), 0.5] / period if period % 2 == 0 else np.ones(period) / period
        half = period // 2
        trend = np.full(len(v), np.nan)
        trend[half:len(v) - half] = np.convolve(v, w, mode="valid")
        assert np.allclose(part["trend"].to_numpy(float), trend, equal_nan=True)
        means = np.array([np.nanmean((v - trend)[i::period]) for i in range(period)])
        season = (means - means.mean())[np.arange(len(v)) % period]
        assert np.allclose(part["seasonal"].to_numpy(float), season)
        assert np.allclose(part["resid"].to_numpy(float), v - trend - season, equal_nan=True)


@pytest.mark.parametrize("chunk", [5, 64, 10_000])
def test_autocorrelation_in_chunks(rows, walks, chunk):
    got = acf(rows, "t", "v", 40, ["k"], chunk).collect()
    for k, v in walks.items():
        d = v - v.mean()
        r = {x["lag"]: x["acf"] for x in got if x["k"] == k}
        assert sorted(r) == list(range(min(41, len(v))))
        assert np.allclose([r[i] for i in sorted(r)], [(d[i:] * d[:len(d) - i]).sum() / (d * d).sum() for i in sorted(r)])


def test_missing_values_take_no_part(spark):
    v = [1.0, None, 4.0, 2.0, float("nan"), 3.0, 5.0]
    df = spark.createDataFrame(list(enumerate(v)), "t long, v double").withColumn("v", F.nanvl("v", F.lit(None)))
    x = np.array([np.nan if y is None else y for y in v], float)
    d = x - np.nanmean(x)
    got = {r["lag"]: r["num"] for r in lagged_products(placed_series(df, "t", "v"), "v", 3, [], 2).collect()}
    assert got == {k: pytest.approx(np.nansum(d[k:] * d[:len(d) - k])) for k in range(4)}


def least_squares(v, lags, choose):
    """The test by lstsq on explicit rows: (rows, lag, statistic)."""
    dy = np.diff(v)

    def design(lag, first):
        t = np.arange(first, len(v))
        return np.column_stack([np.ones(len(t)), v[t - 1], *[dy[t - 1 - j] for j in range(1, lag + 1)]]), dy[t - 1]

    def fit(x, y):
        beta, *_ = np.linalg.lstsq(x, y, rcond=None)
        rss = ((y - x @ beta) ** 2).sum()
        return beta, rss

    if choose:
        aic = []
        for lag in range(lags + 1):
            x, y = design(lag, lags + 1)
            n = len(y)
            aic.append(n * (np.log(2 * np.pi) + np.log(fit(x, y)[1] / n) + 1) + 2 * x.shape[1])
        lags = int(np.argmin(aic))
    x, y = design(lags, lags + 1)
    beta, rss = fit(x, y)
    error = np.sqrt(rss / (len(y) - x.shape[1]) * np.linalg.inv(x.T @ x)[1, 1])
    return len(y), lags, beta[1] / error


@pytest.mark.parametrize("max_lag,choose,chunk", [(None, True, 10_000), (None, True, 23), (6, True, 40), (3, False, 64),
                                                  (0, True, 50)])
def test_augmented_test_equals_least_squares(rows, walks, max_lag, choose, chunk):
    got = {r["k"]: r for r in augmented_dickey_fuller(rows, "t", "v", ["k"], max_lag, choose, chunk).collect()}
    assert set(got) == set(walks)
    for k, v in walks.items():
        lags = default_lags(len(v)) if max_lag is None else min(max_lag, len(v) // 2 - 2)
        n, lag, stat = least_squares(v, lags, choose)
        r = got[k]
        assert (r["n"], r["lag"]) == (n, lag) and r["adf_stat"] == pytest.approx(stat, rel=1e-7)
        assert r["p_value"] == pytest.approx(p_value(stat)) and r["crit_5"] == pytest.approx(
            -2.86154 - 2.8903 / n - 4.234 / n ** 2 - 40.04 / n ** 3)
    if choose and max_lag is None:
        assert got["ar"]["p_value"] < 0.01 < got["walk"]["p_value"]


def test_no_lag_is_the_plain_test(rows):
    plain = {r["k"]: r for r in adf_no_lag(rows, "t", "v", ["k"], chunk=30).collect()}
    for r in augmented_dickey_fuller(rows, "t", "v", ["k"], 0, chunk=30).collect():
        assert r["adf_stat"] == pytest.approx(plain[r["k"]]["adf_stat"]) and r["n"] == plain[r["k"]]["n"]


def test_p_values_at_the_critical_values():
    for crit, p in ((-3.43035, 0.01), (-2.86154, 0.05), (-2.56677, 0.10)):
        assert p_value(crit) == pytest.approx(p, abs=2e-4)
    assert p_value(5.0) == 1.0 and p_value(-30.0) == 0.0
    assert p_value(-1.61 + 1e-9) == pytest.approx(p_value(-1.61), abs=2e-3)


def test_series_without_an_answer(spark):
    rows = [("flat", t, 3.0) for t in range(60)] + [("one", 0, 1.0)] + [("holes", t, None if t == 9 else t ** 0.5) for t in
                                                                        range(60)]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    got = {r["k"]: r["adf_stat"] for r in augmented_dickey_fuller(df, "t", "v", ["k"]).collect()}
    assert got == {"flat": None, "one": None, "holes": None}
    assert augmented_dickey_fuller(df.limit(0), "t", "v", ["k"]).count() == 0
