"""Decomposition, ACF/PACF, Dickey-Fuller and group-first operators against numpy."""

import datetime as dt

import numpy as np
import pandas as pd

from kestrel.operators.timeseries import acf, adf_no_lag, pacf, seasonal_decompose, split_first


def _series(spark, n=60, period=4):
    rng = np.random.default_rng(2)
    t0 = dt.datetime(2024, 1, 1)
    v = np.sin(np.arange(n) * 2 * np.pi / period) * 3 + np.arange(n) * 0.1 + rng.normal(0, 0.3, n)
    pdf = pd.DataFrame({"ts": [t0 + dt.timedelta(hours=i) for i in range(n)], "v": v})
    return spark.createDataFrame(pdf, "ts timestamp_ntz, v double"), v


def test_seasonal_decompose_even_period(spark):
    df, v = _series(spark)
    p = 4
    w = np.r_[0.5, np.ones(p - 1), 0.5] / p
    trend = np.full(len(v), np.nan)
    trend[p // 2: len(v) - p // 2] = np.convolve(v, w, mode="valid")
    det = v - trend
    pa = np.array([np.nanmean(det[i::p]) for i in range(p)])
    pa -= pa.mean()
    got = seasonal_decompose(df, "ts", "v", p).orderBy("idx").toPandas()
    assert np.allclose(got["trend"].to_numpy(dtype=float), trend, equal_nan=True)
    assert np.allclose(got["seasonal"].to_numpy(), np.tile(pa, len(v) // p))


def _acf_np(v, k):
    d = v - v.mean()
    return np.array([np.sum(d[: len(d) - i] * d[i:]) for i in range(k + 1)]) / np.sum(d * d)


def test_acf_and_pacf(spark):
    df, v = _series(spark)
    a = acf(df, "ts", "v", 10).orderBy("lag").toPandas()
    r = _acf_np(v, 10)
    assert np.allclose(a["acf"], r)
    pa = pacf(acf(df, "ts", "v", 10)).orderBy("lag").toPandas()["pacf"].to_numpy()
    # partial autocorrelation k = last coefficient of the order-k Yule-Walker solve
    for k in range(1, 11):
        R = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        phi = np.linalg.solve(R, r[1:k + 1])
        assert abs(pa[k] - phi[-1]) < 1e-9


def test_adf_statistic_matches_ols(spark):
    df, v = _series(spark)
    dy, ylag = np.diff(v), v[:-1]
    X = np.c_[np.ones_like(ylag), ylag]
    beta, res, *_ = np.linalg.lstsq(X, dy, rcond=None)
    sigma2 = res[0] / (len(dy) - 2)
    se = np.sqrt(sigma2 * np.linalg.inv(X.T @ X)[1, 1])
    got = adf_no_lag(df, "ts", "v").first()
    assert abs(got["adf_stat"] - beta[1] / se) < 1e-9


def test_split_first_drops_single_row_groups(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 3), (1, 3, 9), (2, 1, 1)], "k int, o int, v int")
    target, rest = split_first(df, "k", ["o"])
    assert [tuple(r) for r in target.collect()] == [(1, 1, 5)]
    assert sorted(tuple(r) for r in rest.collect()) == [(1, 2, 3), (1, 3, 9)]


def test_pacf_equals_least_squares(spark):
    """The k-th partial autocorrelation is the last coefficient of the Yule-Walker system."""
    import numpy as np
    from kestrel.operators.timeseries import acf, pacf
    rng = np.random.default_rng(0)
    x = [0.0, 0.0]
    for _ in range(400):
        x.append(0.6 * x[-1] - 0.3 * x[-2] + rng.normal())
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(x)], "k string, t long, v double")
    a = acf(df, "t", "v", 6, keys=["k"])
    r = [row.acf for row in a.orderBy("lag").collect()]
    dev = np.array(x) - np.mean(x)
    assert np.allclose(r, [(dev[k:] * dev[:len(dev) - k]).sum() / (dev ** 2).sum() for k in range(7)])
    got = {row.lag: row.pacf for row in pacf(a, keys=["k"]).collect()}
    for k in range(1, 7):
        m = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        assert abs(got[k] - np.linalg.solve(m, np.array(r[1:k + 1]))[-1]) < 1e-9
