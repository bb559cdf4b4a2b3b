"""Metrics against brute force on small fixtures: pairwise AUC, the 1000-threshold
loop, numpy quantiles and histograms."""

import numpy as np
import pandas as pd

from kestrel.operators.metrics import best_f1_threshold, binary_metrics, roc_auc
from kestrel.operators.profile import exact_quantiles, histogram


def _scored(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    s = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0, 1), 2)  # many ties
    return spark.createDataFrame(pd.DataFrame({"label": y, "score": s})), y, s


def test_auc_with_ties(spark):
    df, y, s = _scored(spark)
    pos, neg = s[y == 1], s[y == 0]
    exp = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(roc_auc(df, "label", "score").first()["auc"] - exp) < 1e-12


def _f1(y, p):
    tp = int(((y == 1) & (p == 1)).sum()); fp = int(((y == 0) & (p == 1)).sum()); fn = int(((y == 1) & (p == 0)).sum())
    return 0.0 if 2 * tp + fp + fn == 0 else 2 * tp / (2 * tp + fp + fn)


def test_threshold_sweep_matches_loop(spark):
    df, y, s = _scored(spark)
    best_f1, best_t = 0, 0
    for t in np.arange(0, 1, .001):
        f = _f1(y, (s >= t).astype(int))
        if f > best_f1:
            best_f1, best_t = f, t
    r = best_f1_threshold(df, "label", "score").first()
    assert abs(r["f1"] - best_f1) < 1e-12 and abs(r["threshold"] - best_t) < 1e-12
    m = binary_metrics(df, "label", "score", best_t).first()
    assert abs(m["f1"] - best_f1) < 1e-12


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=1001)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": x * 2})).repartition(5)
    got = exact_quantiles(df, ["x", "y"], [0.25, 0.5, 0.75]).toPandas()
    for c, mult in (("x", 1), ("y", 2)):
        for q in (0.25, 0.5, 0.75):
            v = got[(got.column == c) & (got.q == q)]["value"].iloc[0]
            assert abs(v - np.percentile(x * mult, q * 100)) < 1e-12


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=500)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    got = histogram(df, "x", 20).orderBy("bin").toPandas()
    counts, _ = np.histogram(x, bins=20)
    assert got["count"].tolist() == counts.tolist()


def test_describe_approx_close_to_exact(spark):
    from kestrel.operators.profile import describe
    rng = np.random.default_rng(9)
    df = spark.createDataFrame(pd.DataFrame({"x": rng.normal(size=2000)}))
    ex = describe(df, ["x"]).first()
    ap = describe(df, ["x"], exact=False).first()
    for k in ("p25", "p50", "p75"):
        assert abs(ex[k] - ap[k]) < 0.05
    assert ex["count"] == ap["count"] == 2000
