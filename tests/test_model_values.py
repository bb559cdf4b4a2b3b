"""Values of fitted models on small frames whose answer is known: separable labels, an exact
line, two clusters, a rank-one cloud."""

import threading

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from kestrel.operators import ml
from kestrel.operators.metrics import roc_auc
from kestrel.operators.timeseries import anomaly_flags
from kestrel.plans import flows, models
from kestrel.plans.extra import pitch_flow
from kestrel.plans.flows import loan_dummies
from kestrel.session import cut_lineage


@pytest.fixture(scope="module")
def two(spark):
    """label = 1 where a > 0; b is noise."""
    rng = np.random.default_rng(0)
    rows = [(i, float(a), float(b), float(a > 0)) for i, (a, b) in enumerate(rng.normal(size=(240, 2)))]
    return spark.createDataFrame(rows, "id long, a double, b double, label double").cache()


def auc(model, df):
    return roc_auc(ml.positive_probability(model.transform(df)), "label", "score").first()["auc"]


def test_classifiers_separate(two):
    assert auc(ml.fit_gbt(two, "label", ["a", "b"], maxIter=5, maxDepth=2), two) > 0.99
    forest = ml.fit_rf(two, "label", ["a", "b"], num_trees=10)
    assert auc(forest, two) > 0.99
    imp = dict(ml.feature_importance(forest, ["a", "b"]))
    assert imp["a"] > 0.8 and abs(sum(imp.values()) - 1) < 1e-9
    assert auc(ml.fit_logreg(two, "label", ["a", "b"], maxIter=50, regParam=0.01), two) > 0.99
    assert auc(ml.fit_mlp(two, "label", ["a", "b"], hidden=4, layers=1), two) > 0.98


def test_contributions_are_exact(two):
    model = ml.fit_logreg(two, "label", ["a", "b"], maxIter=50, regParam=0.01)
    row = ml.linear_contributions(model, two, ["a", "b"], [0.5, -1.0]).first()
    coef = model.stages[-1].coefficients
    assert row.contrib == pytest.approx([coef[0] * (row.a - 0.5), coef[1] * (row.b + 1.0)])


def test_loss_falls_with_rounds(two):
    rows = ml.fit_history(two.filter("id % 4 > 0"), two.filter("id % 4 = 0"), "label", ["a", "b"], maxIter=5,
                          maxDepth=2).orderBy("round").collect()
    assert [r.round for r in rows] == [1, 2, 3, 4, 5] and rows[-1].loss < rows[0].loss and rows[-1].val_loss < 1


def test_log_regression_on_an_exact_step(spark):
    df = spark.createDataFrame([(float(i % 4), float(10 ** (i % 4))) for i in range(80)], "x double, y double")
    out = ml.predict_exp(ml.fit_log_regression(df, "y", ["x"], maxIter=20, maxDepth=3), df)
    assert max(abs(r.prediction_exp / r.y - 1) for r in out.collect()) < 0.05


@pytest.fixture(scope="module")
def prices(spark):
    """More rows than Spark draws split candidates from; q has more values than bins, c is constant, z mostly 0."""
    rng = np.random.default_rng(5)
    n = 12_000
    q, d, z = rng.integers(-30, 40, n), rng.normal(size=n), rng.integers(0, 3, n) * (rng.random(n) < 0.1)
    y = np.exp(0.05 * q + d * (z > 0) + rng.normal(size=n))
    return spark.createDataFrame(pd.DataFrame({"id": range(n), "q": q * 1.0, "d": d, "z": z * 1.0, "c": 7.0, "y": y}))


def test_log_regression_is_that_of_the_single_rows(prices):
    """Also with values equal to a split and with null and infinite features in the scored rows."""
    cols = ["q", "d", "z", "c"]
    plain = Pipeline(stages=[ml.assembler(cols), GBTRegressor(labelCol="l", seed=42, maxIter=5, maxDepth=4)]).fit(
        prices.withColumn("l", F.ln("y")))
    model = ml.fit_log_regression(prices, "y", cols, maxIter=5, maxDepth=4)
    odd = prices.limit(300).select(F.col("id") + 10**6, "q", F.when(F.col("id") % 3 == 0, F.lit(float("inf"))).when(
        F.col("id") % 3 == 1, F.lit(float("-inf"))).alias("d"), F.col("z") - 0.5, "c", "y")
    middles = prices.limit(300).select(F.col("id") + 10**7, F.col("q") + 0.5, "d", F.col("z") + 0.5, "c", "y")
    rows = prices.union(odd).union(middles)
    want = {r.id: r.prediction for r in plain.transform(rows).select("id", "prediction").collect()}
    got = {r.id: r.prediction for r in model.transform(rows).select("id", "prediction").collect()}
    assert got.keys() == want.keys() and len(set(want.values())) > 50
    assert max(abs(got[i] - want[i]) for i in want) < 1e-9


def test_log_regression_grows_on_sums_of_all_rows(prices, monkeypatch):
    """The boosted passes read a row per combination of bins; together they weigh all rows."""
    seen = []

    class Watched(GBTRegressor):
        def fit(self, dataset, params=None):
            seen.append((dataset.count(), dataset.agg(F.sum("_rows")).first()[0], dataset.count() <= self.getMaxBins() ** 2))
            return super().fit(dataset, params)

    monkeypatch.setattr(ml, "GBTRegressor", Watched)
    ml.fit_log_regression(prices, "y", ["q", "z", "c"], maxIter=1, maxDepth=2)
    cells, rows, all_candidates = seen[0]
    assert cells <= 33 * 3 and rows == 12_000 and all_candidates


@pytest.mark.parametrize("bad", [{"y": None}, {"q": None}, {"q": float("inf")}])
def test_log_regression_refuses_rows_as_before(prices, bad):
    (col, value), = bad.items()
    df = prices.withColumn(col, F.when(F.col("id") == 5, F.lit(value).cast("double")).otherwise(F.col(col)))
    with pytest.raises(Exception, match="MUST NOT be"):
        ml.fit_log_regression(df, "y", ["q", "d"], maxIter=1, maxDepth=2)


def test_log_regression_takes_parameters_of_single_rows(prices):
    model = ml.fit_log_regression(prices, "y", ["q"], maxIter=1, maxDepth=2, minInstancesPerNode=7000)
    assert model.transform(prices).select("prediction").distinct().count() == 1


def test_searches(two, spark):
    lr = LogisticRegression(labelCol="label", featuresCol="features")
    _, trials = ml.random_search(lr, {"regParam": ("log", 1e-3, 1.0)}, 3, two, "label", ["a", "b"], seed=1)
    assert len(trials) == 3 and all(t["metric"] > 0.95 and 1e-3 <= t["regParam"] <= 1 for t in trials)
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", seed=1)
    _, res = ml.grid_search_cv(forest, {"numTrees": [2, 5]}, two, "label", ["a", "b"], folds=3)
    assert [p["numTrees"] for p, _ in res] == [2, 5] and all(m > 0.9 for _, m in res)
    line = spark.createDataFrame([(float(i), 3.0 * i + 1) for i in range(60)], "x double, label double")
    best, trials = ml.random_search(LinearRegression(labelCol="label", featuresCol="features"),
                                    {"regParam": ("choice", [0.0, 1e4])}, 6, line, "label", ["x"], metric="rmse",
                                    seed=2, minimise=True)
    least = min(trials, key=lambda t: t["metric"])
    assert least["regParam"] == 0.0 and least["metric"] < 1e-6
    assert best.transform(line).agg(F.max(F.abs(F.col("prediction") - F.col("label")))).first()[0] < 1e-6


def test_clusters(spark):
    df = spark.createDataFrame([(i, float(100 * (i % 2)) + i / 100, 1.0 * i) for i in range(40)], "id long, x double, y double")
    out = ml.kmeans_assign(df, ["x"], 2).groupBy("cluster").agg(F.collect_set(F.col("id") % 2).alias("p")).collect()
    assert sorted(r.p for r in out) == [[0], [1]]


def test_residual_of_a_line_and_the_flag(spark):
    rows = [(i, [float(i), 2.0 * i, -1.0 * i], True) for i in range(1, 20)] + [(99, [5.0, -9.0, 4.0], False)]
    df = spark.createDataFrame(rows, "id long, v array<double>, train boolean")
    res = ml.pca_residual(df.filter("train"), df, "v", 1, "id").join(df.select("id", "train"), "id")
    got = {r.id: (r.residual, r.anomaly) for r in anomaly_flags(res, "residual", F.col("train"), fixed=0.5).collect()}
    assert max(v for k, (v, _) in got.items() if k != 99) < 1e-6 and got[99][0] > 1 and got[99][1]
    assert not any(a for k, (_, a) in got.items() if k != 99)


def test_pitch_flow_names_separable_classes(spark):
    rng = np.random.default_rng(1)
    rows = [(i, i % 3, (rng.normal(size=3) * 0.2 + 3 * np.eye(3)[i % 3]).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, label int, f array<double>").select(
        "vec_id", "label", array_to_vector("f").alias("features"))
    metrics, named = pitch_flow(spark, df, "2026-01-01")
    m = metrics.collect()
    assert sorted(r.pitch_type for r in m) == ["class_0", "class_1", "class_2"] and all(r.f1 > 0.95 for r in m)
    assert named.count() == 60 and named.filter("label = predicted").count() >= 58


def test_loan_dummies_reach_the_test_rows(spark):
    schema = ("Id long, is_bad long, emp_length double, home_ownership string, annual_inc double, zip3 int, "
              "delinq_2yrs double, purpose_cat string")
    rows = lambda *cats: spark.createDataFrame(
        [(i, i % 2, 1.0, h, 1.0, 1, 0.0, p) for i, (h, p) in enumerate(cats)], schema)
    train, test = loan_dummies(rows(("RENT", "car"), ("OWN", "small business"), ("RENT", "other")),
                               rows(("RENT", "small business"), ("NONE", "car"), ("OWN", "boat")))
    assert train.columns == test.columns
    dummies = [c for c in test.columns if c.startswith(("home_", "purpose_"))]
    held = [{c for c in dummies if r[c] == 1} for r in test.orderBy("Id").collect()]
    assert held == [{"home_ownership_RENT", "purpose_cat_small business"}, {"purpose_cat_car"}, {"home_ownership_OWN"}]


def test_grid_search_grows_default_trees(spark, monkeypatch):
    asked = {}
    def search(est, grid, *args, folds, **kw):
        asked.update(depth=est.getMaxDepth(), bins=est.getMaxBins(), folds=folds, **grid)
        return None, []
    monkeypatch.setattr(models, "grid_search_cv", search)
    assert models.grid_search_cv_q(spark, "/root/testdata/sf0.001").count() == 0
    plain = RandomForestClassifier()
    assert asked == {"depth": plain.getMaxDepth(), "bins": plain.getMaxBins(), "folds": 10, "numTrees": [10, 100, 1000]}


def test_grid_search_fits_folds_together_with_the_same_scores(two):
    """Fits of three folds wait for one another; one fold after the other never meets."""
    meet, lock, calls = threading.Barrier(3, timeout=60), threading.Lock(), []

    class Meeting(LogisticRegression):
        def fit(self, dataset, params=None):
            with lock:
                calls.append(1)
                early = len(calls) <= 3
            if early:
                meet.wait()
            return super().fit(dataset, params)

    est = Meeting(labelCol="label", featuresCol="features", maxIter=1)
    _, res = ml.grid_search_cv(est, {"regParam": [0.1]}, two, "label", ["a", "b"], folds=3, parallelism=3)
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", maxDepth=1, featureSubsetStrategy="1", seed=1)
    maps = ParamGridBuilder().addGrid(forest.numTrees, [1, 3]).build()
    cv = CrossValidator(estimator=forest, estimatorParamMaps=maps, numFolds=3, seed=0,
                        evaluator=MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy"))
    want = cv.fit(ml.assembler(["a", "b"]).transform(two)).avgMetrics
    model, res = ml.grid_search_cv(forest, {"numTrees": [1, 3]}, two, "label", ["a", "b"], folds=3)
    assert [m for _, m in res] == pytest.approx(want, abs=1e-12)
    assert model.stages[-1].bestModel.getNumTrees == [1, 3][max((0, 1), key=lambda i: (want[i], -i))]


@pytest.mark.parametrize("plans, query", [(models, "rf_target_vector_q"), (flows, "retail_flow_q")])
def test_forest_rows_are_shuffled_once(spark, monkeypatch, plans, query):
    """Fit and scoring read stored rows: their plans hold no shuffle of the orders."""
    seen = []
    real = plans.fit_rf
    monkeypatch.setattr(plans, "fit_rf", lambda rows, *a, **kw: seen.append(rows) or real(rows, *a, **kw))
    getattr(plans, query)(spark, "/root/testdata/sf0.001")
    assert "Exchange" not in seen[0]._jdf.queryExecution().executedPlan().toString()


def test_stored_fit_rows_are_bounded_per_task(spark):
    """A partition above the bound is dealt out; all rows stay."""
    df = spark.range(1000).coalesce(1)
    sizes = [len(p) for p in cut_lineage(df, 300).rdd.glom().collect()]
    assert sum(sizes) == 1000 and len(sizes) == 4 and max(sizes) <= 300
    assert cut_lineage(df, 1000).rdd.getNumPartitions() == 1
    assert cut_lineage(df.filter("id < 0"), 300).count() == 0


@pytest.mark.parametrize("query", ["loan_flow_q", "taxi_flow_q"])
def test_flows_fit_on_bounded_partitions(spark, monkeypatch, query):
    largest = []
    for name in ("fit_gbt", "fit_log_regression"):
        real = getattr(flows, name)
        monkeypatch.setattr(flows, name, lambda rows, *a, f=real, **kw: largest.append(
            max(map(len, rows.rdd.glom().collect()))) or f(rows, *a, **kw))
    monkeypatch.setattr(flows, "FIT_ROWS", 200, raising=False)
    getattr(flows, query)(spark, "/root/testdata/sf0.001")
    assert 0 < largest[0] <= 220
