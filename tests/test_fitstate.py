"""A state grown chunk by chunk is the state of the whole table; sketches keep their bounds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators.features import MinMax, Standardize
from kestrel.operators.fitstate import FitState, partial_fit
from kestrel.session import scratch_path

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(1e6, 1, 30_000), rng.integers(0, 500, 30_000).astype(float)
    made = [(i, float(x), None if i % 7 == 0 else float(y), float("nan") if i % 3 else -0.0) for i, (x, y) in
            enumerate(zip(a, b))]
    return spark.createDataFrame(made, "id long, a double, b double, c double").repartition(6).cache()


def test_chunks_equal_the_whole_table(spark, rows):
    path = scratch_path(spark, "fit")
    for i, (lo, hi) in enumerate([(0, 100), (100, 100), (100, 17_000), (17_000, 17_001), (17_001, 30_000)]):
        state = partial_fit(path, rows.where((F.col("id") >= lo) & (F.col("id") < hi)), COLS, f"part-{i}")
    again = partial_fit(path, rows.where("id < 100"), COLS, "part-0")  # a chunk given twice counts once
    whole = {r["column"]: r for r in FitState.of(rows, COLS).rows.collect()}
    for r in again.rows.collect():
        w = whole[r["column"]]
        assert (r["n"], r["missing"], r["low"], r["high"]) == (w["n"], w["missing"], w["low"], w["high"])
        assert r["mean"] == pytest.approx(w["mean"], rel=1e-13) and r["m2"] == pytest.approx(w["m2"], rel=1e-9, abs=1e-12)
        assert r["chunks"] == [f"part-{i}" for i in range(5)]
    assert whole["c"]["n"] == 10_000 and whole["b"]["missing"] == rows.where("b is null").count()
    assert str(whole["c"]["low"]) == "0.0"
    ab = ["a", "b"]
    mm, known = state.min_max(), MinMax.fit(rows, ab)
    assert {c: mm.mins[c] for c in ab} == known.mins and {c: mm.maxs[c] for c in ab} == known.maxs
    st, known = state.standardize(), Standardize.fit(rows, ab)
    for c in ab:
        assert st.means[c] == pytest.approx(known.means[c]) and st.sds[c] == pytest.approx(known.sds[c], rel=1e-9)


def test_sketches_within_their_bounds(spark, rows):
    parts = [FitState.of(rows.where(F.col("id") % 5 == k), COLS) for k in range(5)]
    out = {r["column"]: r for r in parts[0].merge(*parts[1:]).summary().collect()}
    a = np.sort([r["a"] for r in rows.select("a").collect()])
    for q, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")):
        assert abs(np.searchsorted(a, out["a"][name]) / len(a) - q) < 0.014
    assert abs(out["a"]["distinct"] / 30_000 - 1) < 0.03 and abs(out["b"]["distinct"] / 500 - 1) < 0.03
    assert out["c"]["distinct"] == 1


def test_empty_chunks_and_new_columns(spark, rows):
    none = FitState.of(rows.limit(0), COLS)
    assert [(r["n"], r["low"], r["mean"], r["q50"]) for r in none.summary().collect()] == [(0, None, None, None)] * 3
    both = none.merge(FitState.of(rows, ["a", "id"]))
    got = {r["column"]: r["n"] for r in both.rows.collect()}
    assert got == {"a": 30_000, "b": 0, "c": 0, "id": 30_000}
    path = scratch_path(spark, "fit")
    assert FitState.load(spark, path) is None
    # an unfinished version is not read
    FitState.of(rows, ["a"]).save(path)
    import os
    os.makedirs(f"{path}/v00000001")
    assert FitState.load(spark, path).rows.first()["n"] == 30_000
