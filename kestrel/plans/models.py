"""Model fit / tune / score queries (G1-G17, E13, E14, M10, M13); rows-only checks.

Labelled documents (``labels`` joined to ``documents``) stand in for the tabular
classification sets; ``embeddings`` for image vectors; ``lineitem`` for the
regression rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..functions.numeric import stable_bucket
from ..operators.boosters import fit_booster
from ..operators.features import class_weight
from ..operators.metrics import best_f1_threshold, binary_metrics, compare_scores
from ..operators.ml import (assembler, feature_importance, fit_gbt, fit_history, fit_log_regression, fit_logreg, fit_mlp,
                            fit_rf, grid_search_cv, kmeans_assign, linear_contributions, one_vs_rest_models,
                            pca_residual, positive_probability, predict_exp, random_search, stacked_scores)
from ..operators.project import map_values
from ..operators.reshape import count_vector, vocabulary
from ..operators.search import adaptive_search
from ..operators.timeseries import anomaly_flags, split_first
from ..operators.trees import explain_trees
from ..session import FIT_ROWS, cut_lineage, scratch_path, table
from ..sources.sinks import append_rows
from .registry import query

DOC_FEATURES = ["n_chars", "n_words", "n_lines", "is_en"]


def doc_rows(spark, sf):
    """Labelled documents with numeric features computed from the whole text."""
    lab = table(spark, sf, "labels")
    d = table(spark, sf, "documents")
    feats = d.select("doc_id", F.col("n_chars").cast("double").alias("n_chars"),
                     F.size(F.split("text", r"\s+")).cast("double").alias("n_words"),
                     F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
                     (F.col("lang") == "en").cast("double").alias("is_en"))
    return lab.join(feats, "doc_id").withColumn("label", F.col("quality").cast("double"))


def emb_rows(spark, sf, dims: int | None = None):
    e = table(spark, sf, "embeddings")
    arr = F.slice("embedding", 1, dims) if dims else F.col("embedding")
    return e.select("vec_id", "label", array_to_vector(arr).alias("features"))


@query("gbt_scores")
def gbt_scores_q(spark, sf):
    """Weighted boosted trees with early stopping on a hash-held-out
    validation share; P(quality) for every labelled document."""
    rows = class_weight(doc_rows(spark, sf), "label")
    rows = rows.withColumn("is_valid", stable_bucket("doc_id", 10) < 2)
    model = fit_gbt(rows, "label", DOC_FEATURES, weight="weight", validation="is_valid", maxIter=20, maxDepth=3,
                    stepSize=0.1)
    return positive_probability(model.transform(rows)).select("doc_id", "label", "score")


@query("rf_scores")
def rf_scores_q(spark, sf):
    """Multiclass random forest on image vectors."""
    rows = emb_rows(spark, sf)
    model = fit_rf(rows, "label", ["features"], num_trees=20)
    return model.transform(rows).select("vec_id", "label", F.col("prediction").cast("int").alias("prediction"))


@query("rf_target_vector")
def rf_target_vector_q(spark, sf):
    """First order's priority of each customer is the one-hot target; the
    customer's other orders give the count-vector features; one multiclass forest on
    the class id, its prediction one-hot encoded (unseen class -> all zeros)."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    target, rest = split_first(o, "o_custkey", ["o_orderdate", "o_orderkey"])
    vocab = vocabulary(o, "o_orderpriority")
    feats = count_vector(rest, "o_custkey", "o_orderpriority", vocab, "n_")
    idx = {v: i for i, v in enumerate(vocab)}
    tgt = target.select("o_custkey", map_values("o_orderpriority", idx).cast("double").alias("label"))
    # the fit passes over its rows several times and scoring once more: the shuffles run once
    rows = cut_lineage(feats.join(tgt, "o_custkey"), FIT_ROWS)
    fcols = [f"n_{v}" for v in vocab]
    model = fit_rf(rows, "label", fcols, num_trees=20)
    pred = model.transform(rows)
    onehot = lambda c: F.array(*[(F.col(c) == F.lit(float(i))).cast("int") for i in range(len(vocab))])
    return pred.select("o_custkey", onehot("label").alias("target"), onehot("prediction").alias("predicted"))


@query("random_search")
def random_search_q(spark, sf):
    """Seeded draws from a declared space, each scored on an 80/20
    hold-out; the trial table (the search's model keeps the best draw)."""
    rows = doc_rows(spark, sf)
    space = {"maxDepth": ("int", 2, 5), "maxIter": ("int", 5, 20), "stepSize": ("log", 0.01, 0.3)}
    est = GBTClassifier(labelCol="label", featuresCol="features", seed=42)
    _, trials = random_search(est, space, 4, rows, "label", DOC_FEATURES, seed=7)
    return spark.createDataFrame(trials).select("trial", "maxDepth", "maxIter", "stepSize", "metric")


@query("grid_search_cv")
def grid_search_cv_q(spark, sf):
    """Forest size grid with 10-fold cross-validation."""
    rows = emb_rows(spark, sf)
    est = RandomForestClassifier(labelCol="label", featuresCol="features", seed=42)
    _, res = grid_search_cv(est, {"numTrees": [10, 100, 1000]}, cut_lineage(rows), "label", ["features"], folds=10,
                            parallelism=8)
    return spark.createDataFrame([(p["numTrees"], m) for p, m in res], "num_trees int, accuracy double")


@query("logreg_scores")
def logreg_scores_q(spark, sf):
    """Logistic regression over vocabulary one-hots and numeric columns."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    rows = o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", "c_mktsegment", "o_orderpriority", "c_acctbal", "o_totalprice",
        (F.col("o_orderstatus") == "F").cast("double").alias("label"))
    stages = []
    for col in ("c_mktsegment", "o_orderpriority"):
        stages += [StringIndexer(inputCol=col, outputCol=f"{col}_idx", handleInvalid="keep", stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCol=f"{col}_idx", outputCol=f"{col}_vec", dropLast=True)]
    model = fit_logreg(rows, "label", ["c_mktsegment_vec", "o_orderpriority_vec", "c_acctbal", "o_totalprice"],
                       stages=stages, maxIter=50)
    return positive_probability(model.transform(rows)).select("o_orderkey", "label", "score")


@query("mlp_scores")
def mlp_scores_q(spark, sf):
    """Feed-forward classifier, 2 hidden layers of 8 units, standardised inputs."""
    rows = doc_rows(spark, sf)
    model = fit_mlp(rows, "label", DOC_FEATURES, hidden=8, layers=2)
    return positive_probability(model.transform(rows)).select("doc_id", "label", "score")


@query("log_regression")
def log_regression_q(spark, sf):
    """Boosted regression on ln(price) from numeric columns and a one-hot flag
    (trees need no scaling; the taxi flow shows the min-max variant), fitted on the
    train period; predictions mapped back with exp."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity",
                                             "l_discount", "l_tax", "l_returnflag", "l_shipdate")
    stages = [StringIndexer(inputCol="l_returnflag", outputCol="rf_idx", handleInvalid="keep"),
              OneHotEncoder(inputCol="rf_idx", outputCol="rf_vec", dropLast=True)]
    train = li.filter(F.col("l_shipdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    model = fit_log_regression(train, "l_extendedprice", ["l_quantity", "l_discount", "l_tax", "rf_vec"],
                               stages=stages, maxIter=10, maxDepth=4)
    return predict_exp(model, li).select("l_orderkey", "l_linenumber", "l_extendedprice", "prediction_exp")


@query("pca_anomaly")
def pca_anomaly_q(spark, sf):
    """PCA(8) reconstruction error fitted on the train share; flag rows
    above 1.05 x the largest train error."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    train = e.filter(F.col("vec_id") % 5 != 0)
    res = pca_residual(train, e, "embedding", 8, "vec_id").withColumn("is_train", F.col("vec_id") % 5 != 0)
    return anomaly_flags(res, "residual", F.col("is_train")).drop("is_train")


_OVR: dict = {}


def _ovr_models(spark, sf):
    """All vectors, the classes (guarded: at most 1,000) and one model per class, fitted on the
    hash-chosen 80 % of the rows; the three queries of a session share one fit."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _OVR:
        rows = cut_lineage(emb_rows(spark, sf).withColumn("base_part", stable_bucket("vec_id", 10) < 8))
        classes = vocabulary(rows, "label", max_values=1000)
        base = rows.filter("base_part").drop("base_part")
        _OVR.clear()
        _OVR[key] = (rows, classes, one_vs_rest_models(base, "label", classes, ["features"], maxIter=5, maxDepth=3))
    return _OVR[key]


@query("one_vs_rest_scores")
def one_vs_rest_scores_q(spark, sf):
    """One boosted model per class; each class's score as a column."""
    rows, classes, models = _ovr_models(spark, sf)
    return stacked_scores(rows, models).drop("features", "base_part")


@query("stacked_scores")
def stacked_scores_q(spark, sf):
    """Per-class scores -> forest -> class index -> class name. The forest
    is fitted on the 20 % of the rows that its base models never saw."""
    rows, classes, models = _ovr_models(spark, sf)
    st = stacked_scores(rows, models)
    pred_cols = [f"{c}_pred" for c in classes]
    held = st.filter(~F.col("base_part")).drop("features", "base_part")
    forest = fit_rf(held, "label", pred_cols, num_trees=20)
    names = {float(c): f"class_{c}" for c in classes}
    out = forest.transform(st.drop("features", "base_part"))
    return out.select("vec_id", "label", map_values("prediction", names).alias("predicted_name"))


@query("batch_score")
def batch_score_q(spark, sf):
    """Fitted pipeline scores a whole table; results written and read back."""
    rows = doc_rows(spark, sf)
    model = fit_logreg(rows, "label", DOC_FEATURES, maxIter=30)
    path = scratch_path(spark, "batch-scores")
    positive_probability(model.transform(rows)).select("doc_id", "score").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query("linear_contrib")
def linear_contrib_q(spark, sf):
    """Per-row attributions coef_i * (x_i - mean_i) of a linear model."""
    rows = doc_rows(spark, sf)
    model = fit_logreg(rows, "label", DOC_FEATURES, maxIter=30)
    means = rows.agg(*[F.avg(c).alias(c) for c in DOC_FEATURES]).first()
    return linear_contributions(model, rows, DOC_FEATURES, [means[c] for c in DOC_FEATURES]).select("doc_id", "contrib")


@query("model_roundtrip")
def model_roundtrip_q(spark, sf):
    """Save a fitted pipeline, load it back, score the same rows with
    both and count identical scores."""
    rows = doc_rows(spark, sf)
    model = fit_gbt(rows, "label", DOC_FEATURES, maxIter=10, maxDepth=3)
    path = scratch_path(spark, "gbt-model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = positive_probability(model.transform(rows)).select("doc_id", "score")
    b = positive_probability(loaded.transform(rows)).select("doc_id", "score")
    return compare_scores(a, b, "doc_id", "score", "score")


@query("feature_importance")
def feature_importance_q(spark, sf):
    """Forest feature importances for a returned-item label."""
    feats = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    li = table(spark, sf, "lineitem").select(*feats, (F.col("l_returnflag") == "R").cast("double").alias("label"))
    model = fit_rf(li, "label", feats, num_trees=20, maxDepth=5)
    return spark.createDataFrame(feature_importance(model, feats), "feature string, importance double")


@query("kmeans_summary")
def kmeans_summary_q(spark, sf):
    """K-means on standardised vectors, then count, mean, deviation, minimum and maximum
    of every component per cluster."""
    e = table(spark, sf, "embeddings")
    size = e.select(F.max(F.size("embedding"))).first()[0] or 0
    names = [f"d{i}" for i in range(size)]
    rows = e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])
    assigned = kmeans_assign(rows, names, k=10)
    long = assigned.select("cluster", F.explode(F.array(*[
        F.struct(F.lit(n).alias("column"), F.col(n).alias("value")) for n in names])).alias("kv")).select("cluster", "kv.*")
    return long.groupBy("cluster", "column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))


@query("fit_history")
def fit_history_q(spark, sf):
    """Loss and validation loss per boosting round."""
    rows = doc_rows(spark, sf)
    b = stable_bucket("doc_id", 10)
    return fit_history(rows.filter(b >= 2), rows.filter(b < 2), "label", DOC_FEATURES, maxIter=10, maxDepth=3)


# The field names of a metric row.
METRIC_SCHEMA = ("model_type string, pitch_type string, precision double, accuracy double, recall double, "
                 "f1 double, threshold double, date string")


@query("metric_log_append")
def metric_log_append_q(spark, sf):
    """Per class, F1-best threshold then precision / accuracy / recall / F1,
    appended as metric rows (model, class, date) to a table. The models score the table once."""
    rows, classes, models = _ovr_models(spark, sf)
    st = cut_lineage(stacked_scores(rows, models).drop("features", "base_part"))
    path = scratch_path(spark, "metric-log")
    today = dt.date(2026, 1, 1).isoformat()
    for c in classes:
        y = (F.col("label") == c).cast("int")
        t = best_f1_threshold(st, y, f"{c}_pred").first()["threshold"]
        m = binary_metrics(st, y, f"{c}_pred", t)
        out = m.select(F.lit("gbt").alias("model_type"), F.lit(f"class_{c}").alias("pitch_type"), "precision",
                       "accuracy", "recall", "f1", F.lit(float(t)).alias("threshold"), F.lit(today).alias("date"))
        append_rows(out, path, METRIC_SCHEMA)
    return spark.read.parquet(path)


LOGREG_SPACE = {"regParam": ("log", 1e-4, 1.0), "elasticNetParam": ("float", 0.0, 1.0),
                "maxIter": ("choice", [5, 10, 20])}


@query("param_space_sample")
def param_space_sample_q(spark, sf):
    """Seeded draws from a declared space (log-uniform, uniform, discrete), each
    fitted on an 80/20 hold-out of the labelled documents; every draw is reported with
    its metric and whether it lies inside the declared bounds."""
    from pyspark.ml.classification import LogisticRegression
    rows = doc_rows(spark, sf)
    est = LogisticRegression(labelCol="label", featuresCol="features")
    _, trials = random_search(est, LOGREG_SPACE, 6, rows, "label", DOC_FEATURES, seed=11)
    out = spark.createDataFrame(trials).select("trial", "regParam", "elasticNetParam", "maxIter", "metric")
    inside = (F.col("regParam").between(1e-4, 1.0) & F.col("elasticNetParam").between(0.0, 1.0)
              & F.col("maxIter").isin(5, 10, 20))
    return out.withColumn("in_bounds", inside)


@query("booster_scores")
def booster_scores_q(spark, sf):
    """P(quality) of every labelled document from each kind of booster (trees, trees with
    dropout, linear), fitted through one argument with a validation share that may end the rounds."""
    rows = class_weight(doc_rows(spark, sf), "label").withColumn("held", stable_bucket("doc_id", 10) < 2)
    out = rows.select("doc_id", "label", *DOC_FEATURES)
    for kind, extra in (("gbtree", {"max_depth": 3}), ("dart", {"max_depth": 3, "rate_drop": 0.3, "one_drop": True}),
                        ("gblinear", {"l2": 0.01})):
        model = fit_booster(rows, "label", DOC_FEATURES, kind, rounds=6, weight="weight", valid="held", stop_after=3,
                            **extra)
        out = model.transform(out).withColumnRenamed("score", f"{kind}_score").drop("margin")
    return out.drop(*DOC_FEATURES)


@query("adaptive_search")
def adaptive_search_q(spark, sf):
    """Trials proposed from earlier ones over booster kind, depth, rounds and learning rate, stopped
    at rungs by their validation loss; one row per trial."""
    rows = doc_rows(spark, sf).withColumn("held", stable_bucket("doc_id", 10) < 2)
    space = {"booster": ("choice", ["gbtree", "gblinear", "dart"]), "max_depth": ("int", 2, 4),
             "rounds": ("int", 4, 8), "eta": ("float", 0.1, 0.6)}
    return adaptive_search(rows, "label", DOC_FEATURES, space, 6, "held", rungs=(1, 3), seed=5).table(spark)


@query("tree_contrib")
def tree_contrib_q(spark, sf):
    """Per-row attributions of a boosted tree model; base + their sum is the row's margin."""
    rows = doc_rows(spark, sf)
    model = fit_gbt(rows, "label", DOC_FEATURES, maxIter=8, maxDepth=4)
    vec = assembler(DOC_FEATURES).transform(rows)
    return explain_trees(model.stages[-1], vec).select("doc_id", "contrib", "base", F.col("output").alias("margin"))
