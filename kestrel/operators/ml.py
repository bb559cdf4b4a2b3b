"""Model fit / tune / score as Spark ML stages.

Fitting is Spark ML's distributed training on a ``features`` vector; scoring is a
``transform`` (a narrow map over the rows). Searches sample parameter maps with a
seed and fit them in parallel (``TrainValidationSplit``; for folds, a thread a fit).
The only driver-side data are fitted parameters (coefficients, components), which
are bounded by the feature count.
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, MulticlassClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.ml.feature import PCA, Bucketizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import FIT_ROWS, cut_lineage
from .forests import grown_together, search_forests


def assembler(inputs: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(inputs), outputCol=output, handleInvalid="keep")


def feature_stages(features: Sequence[str]) -> list:
    """Assembler stage, or none when the input already is the ``features`` vector."""
    return [] if list(features) == ["features"] else [assembler(features)]


def positive_probability(df: DataFrame, col: str = "probability", name: str = "score") -> DataFrame:
    """P(class 1) from a probability vector column."""
    return df.withColumn(name, vector_to_array(F.col(col))[1])


def fit_gbt(train: DataFrame, label: str, features: Sequence[str], weight: str | None = None,
            validation: str | None = None, seed: int = 42, **params) -> PipelineModel:
    """Boosted-tree classifier (G1); with ``validation`` (a boolean column) boosting
    stops early on the validation error (G16); ``weight`` is a per-row weight (T9)."""
    gbt = GBTClassifier(labelCol=label, featuresCol="features", seed=seed, **params)
    if weight:
        gbt.setWeightCol(weight)
    if validation:
        gbt.setValidationIndicatorCol(validation)
    return Pipeline(stages=[*feature_stages(features), gbt]).fit(train)


def fit_history(train: DataFrame, valid: DataFrame, label: str, features: Sequence[str], seed: int = 42,
                **params) -> DataFrame:
    """Loss per boosting round on train and validation (M13): the fitted model's
    ``evaluateEachIteration`` on both parts, as one small frame (one row per round)."""
    prep = Pipeline(stages=feature_stages(features)).fit(train)
    model = GBTClassifier(labelCol=label, featuresCol="features", seed=seed, **params).fit(prep.transform(train))
    tl = model.evaluateEachIteration(prep.transform(train))
    vl = model.evaluateEachIteration(prep.transform(valid))
    rows = [(i + 1, float(a), float(b)) for i, (a, b) in enumerate(zip(tl, vl))]  # one per round: bounded
    return train.sparkSession.createDataFrame(rows, "round int, loss double, val_loss double")


def fit_rf(train: DataFrame, label: str, features: Sequence[str], num_trees: int = 20, seed: int = 42,
           **params) -> PipelineModel:
    """Random forest classifier."""
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees, seed=seed, **params)
    return Pipeline(stages=[*feature_stages(features), rf]).fit(train)


def feature_importance(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    """(feature, importance) pairs of a fitted tree ensemble."""
    imp = model.stages[-1].featureImportances.toArray()
    return [(f, float(v)) for f, v in zip(features, imp)]


def fit_logreg(train: DataFrame, label: str, features: Sequence[str], stages=(), **params) -> PipelineModel:
    """Logistic regression over one-hot and numeric columns."""
    lr = LogisticRegression(labelCol=label, featuresCol="features", **params)
    return Pipeline(stages=[*stages, *feature_stages(features), lr]).fit(train)


def fit_mlp(train: DataFrame, label: str, features: Sequence[str], hidden: int, layers: int, seed: int = 42,
            max_iter: int = 50) -> PipelineModel:
    """Feed-forward binary classifier with ``layers`` hidden layers of ``hidden`` units."""
    shape = [len(features)] + [hidden] * layers + [2]
    mlp = MultilayerPerceptronClassifier(labelCol=label, featuresCol="features", layers=shape, seed=seed,
                                         maxIter=max_iter)
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
    return Pipeline(stages=[assembler(features, "raw"), scaler, mlp]).fit(train)


def split_points(values: np.ndarray, counts: np.ndarray, rows: float, bins: int) -> list[float]:
    """Candidate splits of one component, as Spark's trees choose them: the middles between neighbouring
    values, or of those the ones nearest to ``bins`` equal shares when there are more. What is missing
    to ``rows`` counts as zeros."""
    keep = np.isfinite(values) & (values != 0)
    at = dict(zip(values[keep].tolist(), counts[keep].tolist()))
    zeros = rows - sum(at.values())
    if at and zeros > 1e-9:
        at[0.0] = zeros
    values = sorted(at)
    middles = [(a + b) / 2 for a, b in zip(values, values[1:])]
    if len(middles) < bins:
        return middles
    out, seen, stride = [], at[values[0]], rows / bins
    target = stride
    for value, middle in zip(values[1:], middles):
        before, seen = seen, seen + at[value]
        if abs(before - target) < abs(seen - target):
            out.append(middle)
            target += stride
    return out


def candidate_splits(df: DataFrame, col: str, bins: int, seed: int) -> dict[int, list[float]]:
    """Candidate splits of each component of a vector column (none for a constant one), at most
    ``bins`` - 1 a component. As in Spark's trees they come from some max(bins * bins, 10,000) rows; every row
    is binned with them. The rows are drawn as Spark's fit draws them, so that both name the same splits."""
    spark = df.sparkSession
    n = df.count()
    bins, wanted = min(bins, n), max(bins * bins, 10_000)
    drawn = df.select(col)
    if wanted < n:
        draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        rows = drawn._jdf.javaRDD().sample(False, wanted / n, draw)
        drawn = DataFrame(spark._jsparkSession.createDataFrame(rows, drawn._jdf.schema()), spark)
    # bounded: the values of some 10,000 drawn rows
    held = drawn.select(F.posexplode(vector_to_array(col)).alias("at", "value")).groupBy("at", "value").count().toPandas()
    return {int(at): split_points(part["value"].to_numpy(), part["count"].to_numpy(), float(min(wanted, n)), bins)
            for at, part in held.groupby("at")}


class Binned(Transformer):
    """Each component of a vector column becomes the number of its bin between the splits; a value equal to
    a split lies below it, as in Spark's trees. Components without splits become 0; NaN and infinities stay."""

    def __init__(self, splits: Mapping[int, Sequence[float]], input_col: str, output_col: str):
        super().__init__()
        self.splits, self.input_col, self.output_col = dict(splits), input_col, output_col

    def _transform(self, df: DataFrame) -> DataFrame:
        raw = [f"{self.output_col}_raw{i}" for i in self.splits]
        bins = [f"{self.output_col}_bin{i}" for i in self.splits]
        cut = {i: [-np.inf, *np.nextafter(s, np.inf).tolist(), np.inf] for i, s in self.splits.items() if s}
        x = vector_to_array(self.input_col)
        out = df.withColumns({r: x[i] for r, i in zip(raw, self.splits)})
        if cut:
            out = Bucketizer(splitsArray=list(cut.values()), handleInvalid="keep",
                             inputCols=[r for r, i in zip(raw, self.splits) if i in cut],
                             outputCols=[b for b, i in zip(bins, self.splits) if i in cut]).transform(out)
        out = out.withColumns({b: F.when(F.abs(r) < np.inf, F.col(b) if i in cut else F.lit(0.0)).otherwise(F.col(r))
                               for r, b, i in zip(raw, bins, self.splits)})
        return assembler(bins, self.output_col).transform(out).drop(*raw, *bins)


#: Parameters of a boosted regression that hold for rows and for their weighted sums alike.
SUMMED_PARAMS = {"maxIter", "maxDepth", "maxBins", "stepSize", "minInfoGain", "minWeightFractionPerNode",
                 "featureSubsetStrategy", "checkpointInterval", "maxMemoryInMB", "cacheNodeIds"}


def fit_log_regression(train: DataFrame, target: str, features: Sequence[str], stages=(), seed: int = 42,
                       **params) -> PipelineModel:
    """Regression on ln(target); predictions are mapped back with exp.

    Boosting passes over its rows at every level of every tree, yet sees of a row's features only the bins. So all
    rows are binned and added up first, and the trees grow on one weighted row per combination of bins, with the
    mean of its ln(target). Residuals and gains of squared error depend on nothing else, so the trees are those of
    the single rows. Rows that Spark refuses (no target, no finite features) are refused as before. With a
    parameter that counts, draws or weighs single rows, or another loss, the trees grow on the single rows."""
    t = train.withColumn("_log_target", F.ln(F.col(target)))
    if not params.keys() <= SUMMED_PARAMS:
        gbt = GBTRegressor(labelCol="_log_target", featuresCol="features", seed=seed, **params)
        return Pipeline(stages=[*stages, assembler(features), gbt]).fit(t)
    prep = Pipeline(stages=[*stages, assembler(features, "_assembled")]).fit(t)
    points = prep.transform(t).select("_log_target", "_assembled")
    binned = Binned(dict(sorted(candidate_splits(points, "_assembled", params.pop("maxBins", 32), seed).items())),
                    "_assembled", "features")
    x = vector_to_array("features")
    keys = [f"_x{i}" for i in binned.splits]
    y = F.col("_log_target")
    cells = cut_lineage(
        binned.transform(points).select("_log_target", *[x[i].alias(k) for k, i in zip(keys, binned.splits)])
        .groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias("_rows"),
                            F.when(F.count(y) == F.count(F.lit(1)), F.avg(y)).alias("_log_target")), FIT_ROWS)
    # so many bins that every cell counts as a candidate, none is drawn
    every = max(32, int(np.ceil(np.sqrt(cells.count()))))
    gbt = GBTRegressor(labelCol="_log_target", featuresCol="features", weightCol="_rows", seed=seed, maxBins=every,
                       **params)
    return PipelineModel([*prep.stages, binned, gbt.fit(assembler(keys).transform(cells))])


def predict_exp(model: PipelineModel, df: DataFrame, name: str = "prediction_exp") -> DataFrame:
    return model.transform(df).withColumn(name, F.exp("prediction"))


def sample_param_maps(space: Mapping[str, tuple], n: int, seed: int = 0) -> list[dict]:
    """Seeded draws from a declared space (G6): ('int', lo, hi), ('float', lo, hi),
    ('log', lo, hi) (log-uniform) or ('choice', [values])."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        draw = {}
        for name, spec in space.items():
            kind = spec[0]
            if kind == "int":
                draw[name] = rng.randint(spec[1], spec[2])
            elif kind == "float":
                draw[name] = rng.uniform(spec[1], spec[2])
            elif kind == "log":
                draw[name] = float(np.exp(rng.uniform(np.log(spec[1]), np.log(spec[2]))))
            elif kind == "choice":
                draw[name] = rng.choice(list(spec[1]))
            else:
                raise ValueError(f"unknown space kind {kind}")
        out.append(draw)
    return out


def random_search(estimator, space: Mapping[str, tuple], n: int, train: DataFrame, label: str,
                  features: Sequence[str], metric: str = "areaUnderROC", seed: int = 0,
                  train_ratio: float = 0.8, parallelism: int = 4, minimise: bool = False):
    """Random search with a seeded hold-out (G4, G6): each sampled map is fitted on
    the train share and scored on the rest; returns (best PipelineModel, trials). With
    ``minimise`` the metric is one of a regression (rmse, mse, mae) and its least value is best."""
    draws = sample_param_maps(space, n, seed)
    maps = [{getattr(estimator, k): v for k, v in d.items()} for d in draws]
    ev = (RegressionEvaluator(labelCol=label, metricName=metric) if minimise
          else BinaryClassificationEvaluator(labelCol=label, metricName=metric))
    tvs = TrainValidationSplit(estimator=estimator, estimatorParamMaps=maps, evaluator=ev,
                               trainRatio=train_ratio, seed=seed, parallelism=parallelism)
    fitted = Pipeline(stages=[*feature_stages(features), tvs]).fit(train)
    trials = [dict(d, trial=i, metric=float(m)) for i, (d, m) in enumerate(zip(draws, fitted.stages[-1].validationMetrics))]
    return fitted, trials


def grid_search_cv(estimator, grid: Mapping[str, Sequence], train: DataFrame, label: str,
                   features: Sequence[str], folds: int = 10, seed: int = 0, parallelism: int = 4):
    """Grid search with k-fold cross-validation (G5, L19); returns (model, rows).

    ``CrossValidator`` fits one fold after the other, so that a small table keeps a few cores busy.
    Here the fits of all folds and parameter maps run ``parallelism`` at a time; folds are those of
    ``CrossValidator`` (ranges of a seeded random number), kept once for all fits. Forests of all folds and
    maps grow side by side (``forests``), where their parameters allow it; they are those of Spark's fits."""
    b = ParamGridBuilder()
    for k, vals in grid.items():
        b = b.addGrid(getattr(estimator, k), list(vals))
    maps = b.build()
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    prep = PipelineModel(feature_stages(features))
    ready = prep.transform(train)

    def searched(means: list[float], fit) -> tuple:
        best = fit(int(np.argmax(means)))
        rows = [({p.name: v for p, v in m.items()}, s) for m, s in zip(maps, means)]
        return PipelineModel([*prep.stages, CrossValidatorModel(best, avgMetrics=means)]), rows

    if type(estimator) is RandomForestClassifier:
        forests = [estimator.copy(m) for m in maps]
        found = grown_together(forests, ready, label) and search_forests(forests, ready, label, folds, seed,
                                                                         candidate_splits, parallelism)
        if found:
            return searched([float(np.mean(s)) for s in found[0]], found[1])
    dealt = ready.select("*", F.rand(seed).alias("_fold_at")).persist()

    def score(task: tuple[int, int]) -> float:
        fold, m = task
        share = 1.0 / folds
        held = (F.col("_fold_at") >= fold * share) & (F.col("_fold_at") < (fold + 1) * share)
        fitted = estimator.fit(dealt.filter(~held), maps[m])
        return float(ev.evaluate(fitted.transform(dealt.filter(held))))

    tasks = [(f, m) for f in range(folds) for m in range(len(maps))]
    pool = ThreadPool(min(parallelism, len(tasks)))
    try:
        scores = pool.map(inheritable_thread_target(train.sparkSession)(score), tasks, chunksize=1)
    finally:
        pool.terminate()
        dealt.unpersist()
    means = [float(np.mean(scores[m::len(maps)])) for m in range(len(maps))]
    return searched(means, lambda m: estimator.fit(ready, maps[m]))


def one_vs_rest_models(train: DataFrame, cls: str, values: Sequence, features: Sequence[str],
                       seed: int = 42, **params) -> dict:
    """One binary boosted-tree model per class value (G11); the train frame should be
    persisted by the caller since it is scanned once per class."""
    out = {}
    for v in values:
        t = train.withColumn("_y", (F.col(cls) == F.lit(v)).cast("double"))
        out[v] = fit_gbt(t, "_y", features, seed=seed, **params)
    return out


def stacked_scores(df: DataFrame, models: Mapping, suffix: str = "_pred") -> DataFrame:
    """Add each one-vs-rest model's positive probability as a column (T11), one
    narrow transform per model over the same rows."""
    out = df
    for v, m in models.items():
        scored = m.transform(out).withColumn(f"{v}{suffix}", vector_to_array("probability")[1])
        added = [c for c in scored.columns if c not in out.columns and c != f"{v}{suffix}"]
        out = scored.drop(*added)
    return out


def pca_residual(train: DataFrame, df: DataFrame, array_col: str, k: int, key: str) -> DataFrame:
    """Reconstruction error from a k-component PCA fitted on train (G10): the mean
    |x - V V^T x| per row. Components (dims x k) are bounded by the dimension; the
    projection runs in Arrow batches."""
    vec = train.select(array_to_vector(array_col).alias("v"))
    model = PCA(k=k, inputCol="v", outputCol="p").fit(vec)
    V = model.pc.toArray()  # dims x k
    P = V @ V.T

    @F.pandas_udf("double")
    def residual(arrs: pd.Series) -> pd.Series:
        X = np.vstack(arrs.to_numpy()).astype(float)
        R = X - X @ P
        return pd.Series(np.abs(R).mean(axis=1))

    return df.select(key, residual(F.col(array_col)).alias("residual"))


def linear_contributions(model: PipelineModel, df: DataFrame, features: Sequence[str], means: Sequence[float],
                         name: str = "contrib") -> DataFrame:
    """Per-row attributions of a linear model: coef_i * (x_i - mean_i) as an array."""
    coef = model.stages[-1].coefficients.toArray()
    parts = [F.lit(float(c)) * (F.col(f) - F.lit(float(m))) for c, f, m in zip(coef, features, means)]
    return df.withColumn(name, F.array(*parts))


def kmeans_assign(df: DataFrame, features: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    """Standardise, cluster with k-means, attach the cluster id."""
    pipe = Pipeline(stages=[assembler(features, "raw"),
                            StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
                            KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster")])
    return pipe.fit(df).transform(df).drop("raw", "features")
