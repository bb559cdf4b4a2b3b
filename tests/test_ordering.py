"""Distributed positions and running sums equal the single-machine answer, also with
a key holding most rows and many partitions."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from kestrel.operators.ordering import chunk_ids, global_row_index, global_running_sum, percent_range, rank_within


def _skewed(spark, n=3000):
    rng = np.random.default_rng(1)
    g = np.where(rng.random(n) < 0.6, 0, rng.integers(1, 20, n))
    pdf = pd.DataFrame({"id": np.arange(n), "g": g, "v": rng.integers(0, 5, n)})
    return spark.createDataFrame(pdf).repartition(7), pdf


def test_global_row_index(spark):
    df, pdf = _skewed(spark)
    got = global_row_index(df, ["v", "id"], "pos", num_partitions=6, total="n").toPandas()
    exp = pdf.sort_values(["v", "id"]).reset_index(drop=True)
    m = got.set_index("id").loc[exp["id"]]
    assert (m["pos"].to_numpy() == np.arange(len(exp))).all()
    assert (got["n"] == len(pdf)).all()


def test_rank_within_hot_group(spark):
    df, pdf = _skewed(spark)
    got = rank_within(df, "g", ["v", "id"], "pos").toPandas().set_index("id")
    exp = pdf.sort_values(["g", "v", "id"]).groupby("g").cumcount()
    assert (got.loc[exp.index, "pos"].to_numpy() == exp.to_numpy()).all()


def test_running_sum(spark):
    df, pdf = _skewed(spark)
    got = global_running_sum(df, ["id"], ["v"], num_partitions=5).toPandas().sort_values("id")
    assert (got["v_cum"].to_numpy() == pdf.sort_values("id")["v"].cumsum().to_numpy()).all()


def test_chunks_and_percent_range(spark):
    df, pdf = _skewed(spark)
    ch = chunk_ids(df, ["id"], 200).toPandas().sort_values("id")
    assert (ch["chunk_id"].to_numpy() == np.arange(len(pdf)) // 200).all()
    pr = percent_range(df, ["id"], 10, 12).select("id").toPandas()
    assert sorted(pr["id"]) == list(range(300, 360))
    assert df.filter(F.col("g") == 0).count() > len(pdf) / 2
