"""Split properties: disjoint, complete, exact per-class proportions, boundary rows."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from kestrel.operators.split import hash_split, split_counts, stratified_split, time_split


def test_stratified_split_exact_and_complete(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"id": np.arange(1000), "y": (rng.random(1000) < 0.8).astype(int)})
    df = spark.createDataFrame(pdf)
    out = stratified_split(df, "y", "id", [("train", 0.7), ("valid", 0.15), ("test", 0.15)], seed=42).toPandas()
    assert sorted(out["id"]) == list(range(1000))
    for y, g in out.groupby("y"):
        n = (pdf.y == y).sum()
        assert (g.part == "train").sum() == int(np.floor(n * 0.7))
        assert (g.part == "valid").sum() == int(np.floor(n * 0.15))


def test_hash_split_conserves_rows(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    parts = hash_split(df, "k", [("train", 8), ("valid", 1), ("test", 1)])
    r = split_counts(parts).first()
    assert r["conserved"] and r["n_total"] == 5000
    assert 0.75 < r["n_train"] / 5000 < 0.85


def test_time_split_inclusive_boundary(spark):
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-01-02 00:00:00"), (3, "2024-01-03 00:00:00")],
                               "id int, t string").select("id", F.col("t").cast("timestamp_ntz").alias("ts"))
    out = sorted(tuple(r) for r in time_split(df, "ts", "2024-01-02 00:00:00").select("id", "part").collect())
    assert out == [(1, "train"), (2, "test"), (2, "train"), (3, "test")]
