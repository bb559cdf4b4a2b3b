"""Forests grown side by side are those of Spark's own fits."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

from kestrel.operators import forests, ml
from kestrel.session import cut_lineage


@pytest.fixture(scope="module")
def four(spark):
    """Four classes by the signs of two of seven features, some labels wrong; three partitions, one of them empty."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 7)).round(2)
    x[:, 5] = 1.5
    y = np.where(rng.random(400) < 0.1, 0, 2 * (x[:, 1] > 0) + (x[:, 3] > 0.2))
    rows = [(int(a), b.tolist()) for a, b in zip(y, x)]
    df = spark.createDataFrame(rows[:250], "label int, f array<double>").coalesce(1)
    for part in ([], rows[250:]):
        df = df.union(spark.createDataFrame(part, df.schema).coalesce(1))
    return cut_lineage(df.select("label", array_to_vector("f").alias("features")))


def nodes(model, spark, path):
    model.write().save(str(path))
    found = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    return sorted(found, key=lambda r: (r["treeID"], r["id"]))


@pytest.mark.parametrize("params", [{}, {"maxDepth": 3, "minInstancesPerNode": 9, "featureSubsetStrategy": "2"},
                                    {"maxMemoryInMB": 0, "maxDepth": 2}, {"bootstrap": False, "subsamplingRate": 0.5}])
def test_search_grows_spark_s_forests_without_its_fits(spark, four, tmp_path, monkeypatch, params):
    est = RandomForestClassifier(labelCol="label", featuresCol="features", seed=11, **params)
    sizes = [1, 6, 13] if params.get("maxMemoryInMB") is None else [1, 3]
    ev = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    want = CrossValidator(estimator=est, estimatorParamMaps=ParamGridBuilder().addGrid(est.numTrees, sizes).build(),
                          numFolds=3, seed=0, evaluator=ev).fit(four)
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda *a, **kw: pytest.fail("a fit for itself"))
    model, res = ml.grid_search_cv(est, {"numTrees": sizes}, four, "label", ["features"], folds=3)
    assert [m for _, m in res] == want.avgMetrics
    best = model.stages[-1].bestModel
    assert nodes(best, spark, tmp_path / "a") == nodes(want.bestModel, spark, tmp_path / "b")
    assert best.transform(four).exceptAll(want.bestModel.transform(four)).isEmpty()
    given = [{p.name: m.getOrDefault(p) for p in m.params if m.isSet(p)} for m in (best, want.bestModel)]
    assert given[0] == given[1]
    assert best.summary.accuracy == want.bestModel.summary.accuracy


def test_blocks_above_the_bound_are_dealt_out(four, monkeypatch):
    """All rows stay and are held out once, whatever the blocks."""
    monkeypatch.setattr(forests, "BLOCK_ROWS", 60)
    rows = []
    real = forests.held_out

    def scored(forest, wide):
        work = real(forest, wide)
        rows.append(sum(n for *_, n in work(held.collect())))
        return work

    def kept(dealt, cuts, real=forests.blocks):
        nonlocal held
        sizes = [len(p) for p in dealt.rdd.glom().collect()]
        assert max(sizes) < 90 and sum(sizes) == 400
        held = real(dealt, cuts).select("bins", "labels", "folds")
        return real(dealt, cuts)

    held = None
    monkeypatch.setattr(forests, "held_out", scored)
    monkeypatch.setattr(forests, "blocks", kept)
    est = RandomForestClassifier(labelCol="label", featuresCol="features", seed=11)
    stored = forests.search_forests([est.copy({est.numTrees: 5})], four, "label", 4, 0, ml.candidate_splits)
    assert rows == [400]
    assert all(0.6 < s <= 1 for s in stored[0][0]) and stored[1](0).getNumTrees == 5


def test_rows_that_spark_refuses_are_left_to_its_fit(spark, four):
    est = RandomForestClassifier(labelCol="label", featuresCol="features", seed=11)
    for bad in ("CAST(NULL AS INT)", "-1"):
        df = four.selectExpr(f"IF(rand(1) < 0.1, {bad}, label) label", "features")
        with pytest.raises(Exception, match="(?i)label"):
            ml.grid_search_cv(est, {"numTrees": [2]}, df, "label", ["features"], folds=2)
    assert not forests.grown_together([est.copy({est.impurity: "entropy"})], four, "label")


def test_scala_map_order(spark):
    for keys in (range(1000), range(0, 999, 7), [3, 17, 900], [1, 33, 65, 97, 129, 1025]):
        held = spark._jvm.java.util.HashMap()
        for k in keys:
            held.put(k, 1)
        order = spark._jvm.org.apache.spark.api.python.PythonUtils.toScalaMap(held).keysIterator().mkString(",")
        assert forests.map_order(list(keys)) == [int(k) for k in order.split(",")]
