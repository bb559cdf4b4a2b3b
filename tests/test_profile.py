"""Correlations and reports against pandas."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators.profile import corr_matrix, data_summary, profile_report


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(500, 2)) @ np.array([[1, 0.4], [0, 1]]) + 1e6
    made = [(i, float(a), None if i % 9 == 0 else float(b), 3.25, "u" if i % 4 else "v", float("nan") if i % 5 else 0.0)
            for i, (a, b) in enumerate(x)]
    return spark.createDataFrame(made, "id long, a double, b double, flat double, s string, n double").repartition(4).cache()


def test_correlations_equal_pandas(rows):
    cols = ["id", "a", "b", "flat", "n"]
    got = {(r["a"], r["b"]): r["corr"] for r in corr_matrix(rows, cols).collect()}
    want = rows.toPandas()[cols].corr()
    for a in cols:
        for b in cols:
            if np.isnan(want.loc[a, b]):
                assert got[a, b] is None or np.isnan(got[a, b])
            else:
                assert got[a, b] == pytest.approx(want.loc[a, b], abs=1e-9)
    assert {r["corr"] for r in corr_matrix(rows.limit(0), ["a", "b"]).collect()} == {None}


def test_report_covers_every_column(rows):
    got = {r["column"]: r for r in profile_report(rows, top=2).collect()}
    assert set(got) == set(rows.columns)
    assert [tuple(v) for v in got["s"]["top_values"]] == [("u", 375), ("v", 125)] and got["s"]["mean"] is None
    assert got["b"]["missing_pct"] == pytest.approx(100 * rows.where("b is null").count() / 500)
    assert got["flat"]["unique"] == 1 and got["flat"]["std"] == 0 and got["id"]["p50"] == 249.5
    empty = {r["column"]: r for r in profile_report(rows.limit(0)).collect()}
    assert empty["a"]["unique"] == 0 and empty["a"]["missing_pct"] is None and empty["a"]["top_values"] is None


def test_summary_counts(rows):
    r = {x["column"]: x for x in data_summary(rows.withColumn("z", F.col("id") % 3), ["b", "z"]).collect()}
    assert (r["z"]["zeros"], r["z"]["unique"], r["z"]["nulls"]) == (167, 3, 0)
    assert r["b"]["nulls"] == 56 and r["b"]["unique"] == 444
