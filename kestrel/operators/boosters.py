"""Boosters of three kinds behind one argument (G1): trees, linear, and trees with dropout.

Each round is a few aggregates over the rows; only sums that the feature count bounds come to the
driver. ``Boosting`` keeps a fit open, so a search can grow it rung by rung (G6).

* ``gbtree``: Newton boosting. A round fits a weighted Spark ML regression tree to the targets
  -g/h with weights h (its variance gain is then the second-order gain) and sets each leaf to
  -G/(H + l2) from one grouped sum.
* ``dart``: the same with dropout. Each earlier tree is left out with probability ``rate_drop``
  while the new tree is fitted; then the new tree gets eta / (k + eta) and each of the k
  dropped trees is scaled by k / (k + eta).
* ``gblinear``: elastic-net coordinate descent on the round's sums of gradients and of
  second-order products. Their Gram matrix holds all that one cycle over the coordinates needs
  (a step in j moves the gradient of k by its entry j, k), so a cycle costs one pass over the
  rows. ``updater="parallel"`` moves all coordinates at once from their own sums (2 d sums
  instead of d * d, for wide features; choose a small eta).
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ml import feature_stages
from .trees import Tree, contributions, grown_tree, leaves, matrix, mean_value, set_covers, tree_outputs

#: Default learning rate and l2 penalty of each booster.
DEFAULTS = {"gbtree": (0.3, 1.0), "dart": (0.3, 1.0), "gblinear": (0.5, 0.0)}
#: Least curvature of a row; trees whose outputs are computed again each round before they are stored.
LEAST_CURVE, FRESH_TREES = 1e-16, 16


def _features(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, Column]:
    """The rows with a ``features`` vector, and it as an array."""
    stages = feature_stages(features)
    out = Pipeline(stages=stages).fit(df).transform(df) if stages else df
    return out, vector_to_array(F.col("features"))


class BoosterModel(NamedTuple):
    """A fitted booster: trees with their weights, or bias and coefficients."""
    booster: str
    objective: str
    features: list
    trees: list
    weights: list
    bias: float
    coef: list

    def margin(self, x: Column) -> Column:
        """The margin of a feature array column."""
        if self.booster == "gblinear":
            terms = F.zip_with(x, F.array(*[F.lit(float(c)) for c in self.coef]), lambda a, b: a * b)
            return F.aggregate(terms, F.lit(float(self.bias)), lambda a, b: a + b)
        return _weighted(tree_outputs(self.trees, x), self.weights)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``margin`` and, of a logistic model, ``score`` = P(label 1)."""
        rows, x = _features(df, self.features)
        added = [self.margin(x).alias("margin")]
        if self.objective == "logistic":
            added.append((1 / (1 + F.exp(-added[0]))).alias("score"))
        return rows.select(*df.columns, *added)

    def explain(self, df: DataFrame) -> DataFrame:
        """Add ``contrib`` (one value a feature), ``base`` and ``margin``; they add up for every row."""
        rows, x = _features(df, self.features)
        if self.booster == "gblinear":
            contrib = F.zip_with(x, F.array(*[F.lit(float(c)) for c in self.coef]), lambda a, b: a * b)
            base = self.bias
        else:
            contrib = contributions(self.trees, self.weights, x)
            base = sum(w * mean_value(t) for t, w in zip(self.trees, self.weights, strict=True))
        return rows.select(*df.columns, contrib.alias("contrib"), F.lit(float(base)).alias("base"),
                           self.margin(x).alias("margin"))

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the model as one JSON line."""
        trees = [{**{k: getattr(t, k).tolist() for k in t._fields[:-1]},
                  "left_set": {str(n): sorted(s) for n, s in t.left_set.items()}} for t in self.trees]
        spark.createDataFrame([(json.dumps({**self._asdict(), "trees": trees}),)], "value string").coalesce(1).write.mode(
            "overwrite").text(path)


def load_booster(spark: SparkSession, path: str) -> BoosterModel:
    """A model that ``BoosterModel.save`` wrote."""
    d = json.loads(spark.read.text(path).first()["value"])
    d["trees"] = [Tree(*[np.array(t[k]) for k in Tree._fields[:-1]],
                       {int(n): frozenset(s) for n, s in t["left_set"].items()}) for t in d["trees"]]
    return BoosterModel(**d)


def _weighted(outputs: Column, weights: Sequence[float]) -> Column:
    if not weights:
        return F.lit(0.0)
    terms = F.zip_with(outputs, F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b)
    return F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)


def soft_step(g: float, h: float, w: float, l1: float, l2: float) -> float:
    """The change of a coefficient that minimises g d + h d^2 / 2 + l2 (w + d)^2 / 2 + l1 |w + d|."""
    if h < 1e-5:
        return 0.0
    z = h * w - g
    return math.copysign(max(abs(z) - l1, 0.0), z) / (h + l2) - w


def draw_dropped(rng: random.Random, trees: int, rate_drop: float, skip_drop: float, one_drop: bool) -> list[int]:
    """Earlier trees to leave out in a round: one draw for skipping, one a tree, one to choose the only tree."""
    if not trees or rng.random() < skip_drop:
        return []
    out = [i for i in range(trees) if rng.random() < rate_drop]
    return out or ([rng.randrange(trees)] if one_drop else [])


class Boosting:
    """A boosted fit that can be grown further: ``grow(n)`` adds rounds, ``model()`` gives the model.

    ``history`` holds (round, training loss, validation loss or None) after each round. Rows with
    a true ``valid`` column are scored but not fitted. Null weights count as 1; rows with a null label
    are left out.
    """

    def __init__(self, rows: DataFrame, label: str, features: Sequence[str], booster: str = "gbtree",
                 objective: str = "logistic", weight: str | None = None, valid: str | None = None, seed: int = 0,
                 eta: float | None = None, l1: float = 0.0, l2: float | None = None, max_depth: int = 6,
                 max_bins: int = 32, rate_drop: float = 0.0, skip_drop: float = 0.0, one_drop: bool = False,
                 updater: str = "cyclic"):
        if booster not in DEFAULTS or objective not in ("logistic", "squared") or updater not in ("cyclic", "parallel"):
            raise ValueError(f"unknown booster, objective or updater: {booster}, {objective}, {updater}")
        self.booster, self.objective, self.features, self.updater = booster, objective, list(features), updater
        self.eta = DEFAULTS[booster][0] if eta is None else eta
        self.l1, self.l2 = l1, DEFAULTS[booster][1] if l2 is None else l2
        self.max_depth, self.max_bins, self.seed = max_depth, max_bins, seed
        self.drop = (rate_drop, skip_drop, one_drop) if booster == "dart" else (0.0, 0.0, False)
        self.rng = random.Random(seed)
        self.trees: list[Tree] = []
        self.weights: list[float] = []
        self.history: list[tuple] = []
        made, x = _features(rows.where(F.col(label).isNotNull()), features)
        self.state = cut_lineage(made.select(
            x.alias("x"), F.col(label).cast("double").alias("y"),
            (F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight else F.lit(1.0)).alias("w"),
            (F.coalesce(F.col(valid), F.lit(False)) if valid else F.lit(False)).alias("held"),
            F.array().cast("array<double>").alias("outs")))
        self.stored = 0
        first = self.state.select(F.size("x").alias("d")).first()
        self.dim = first["d"] if first else 0
        self.bias, self.coef = 0.0, [0.0] * self.dim
        self._sums = None

    @property
    def rounds(self) -> int:
        return len(self.history)

    def model(self) -> BoosterModel:
        return BoosterModel(self.booster, self.objective, self.features, list(self.trees), list(self.weights), self.bias,
                            list(self.coef))

    def grow(self, rounds: int) -> Boosting:
        for _ in range(rounds):
            self._linear_round() if self.booster == "gblinear" else self._tree_round()
        return self

    # -- trees

    def _outputs(self) -> Column:
        fresh = self.trees[self.stored:]
        return F.concat("outs", tree_outputs(fresh, F.col("x"))) if fresh else F.col("outs")

    def _gradients(self, margin: Column) -> tuple[Column, Column]:
        if self.objective == "squared":
            return (margin - F.col("y")), F.lit(1.0)
        p = 1 / (1 + F.exp(-margin))
        return p - F.col("y"), F.greatest(p * (1 - p), F.lit(LEAST_CURVE))

    def _tree_round(self) -> None:
        dropped = set(draw_dropped(self.rng, len(self.trees), *self.drop))
        kept = [0.0 if i in dropped else w for i, w in enumerate(self.weights)]
        rows = self.state.select("x", "y", "w", "held", self._outputs().alias("outs"))
        rows = rows.withColumn("margin", _weighted(F.col("outs"), kept))
        g, h = self._gradients(F.col("margin"))
        train = rows.where("not held and w > 0").select(
            array_to_vector("x").alias("features"), "x", (-g / h).alias("target"), (F.col("w") * h).alias("h"),
            (F.col("w") * g).alias("g"))
        train = train.persist()  # each level of the tree reads it
        fitted = DecisionTreeRegressor(featuresCol="features", labelCol="target", weightCol="h", maxDepth=self.max_depth,
                                       maxBins=self.max_bins, seed=self.seed).fit(train.select("features", "target", "h"))
        tree = grown_tree(fitted)

        @F.pandas_udf("long")
        def leaf(batch):
            import pandas as pd
            return pd.Series(leaves(tree, matrix(batch)))

        sums = train.groupBy(leaf("x").alias("leaf")).agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
        sums = sums.collect()  # one row a leaf
        train.unpersist()
        for r in sums:
            tree.value[r["leaf"]] = -r["g"] / (r["h"] + self.l2)
        set_covers(tree, {r["leaf"]: r["h"] for r in sums})
        k = len(dropped)
        for i in dropped:
            self.weights[i] *= k / (k + self.eta)
        self.trees.append(tree)
        self.weights.append(self.eta / (k + self.eta) if k else self.eta)
        if len(self.trees) - self.stored >= FRESH_TREES:
            self.state = cut_lineage(self.state.select("x", "y", "w", "held", self._outputs().alias("outs")))
            self.stored = len(self.trees)
        after = self.state.select("y", "w", "held", _weighted(self._outputs(), self.weights).alias("margin"))
        if self.objective == "squared":
            loss = (F.col("margin") - F.col("y")) ** 2
        else:
            m = F.when(F.col("y") > 0.5, -F.col("margin")).otherwise(F.col("margin"))
            loss = F.greatest(m, F.lit(0.0)) + F.log1p(F.exp(-F.abs(m)))
        found = {r["held"]: r["loss"] for r in after.groupBy("held").agg(
            F.try_divide(F.sum(F.col("w") * loss), F.sum("w")).alias("loss")).collect()}
        self.history.append((len(self.trees), found.get(False), found.get(True)))

    # -- linear

    def _pass(self) -> np.ndarray:
        """One pass: losses and weights, sums of g, g x, h, h x, and of h x x' (or only its diagonal)."""
        coef, bias, d = np.array(self.coef), self.bias, self.dim
        squared, full = self.objective == "squared", self.updater == "cyclic"

        def partial(batches: Iterator) -> Iterator:
            import pyarrow as pa

            total = None
            for b in batches:
                if not b.num_rows:
                    continue
                x = np.asarray(b.column(0).values.slice(b.column(0).offsets[0].as_py(), b.num_rows * d), float)
                x = np.hstack([np.ones((b.num_rows, 1)), x.reshape(-1, d)])
                y, w, held = (b.column(c).to_numpy(zero_copy_only=False) for c in (1, 2, 3))
                m = x @ np.concatenate([[bias], coef])
                if squared:
                    g, h, loss = m - y, np.ones(len(m)), (m - y) ** 2
                else:
                    p = 1 / (1 + np.exp(-m))
                    g, h = p - y, np.maximum(p * (1 - p), LEAST_CURVE)
                    s = np.where(y > 0.5, -m, m)
                    loss = np.maximum(s, 0) + np.log1p(np.exp(-np.abs(s)))
                t = ~held
                g, h, xt = (w * g)[t], (w * h)[t], x[t]
                products = (xt * h[:, None]).T @ xt
                if not full:
                    products = np.stack([products[0], np.diag(products)]) if len(xt) else np.zeros((2, d + 1))
                row = np.concatenate([[(w * loss)[t].sum(), w[t].sum(), (w * loss)[held].sum(), w[held].sum()], xt.T @ g,
                                      products.ravel()])
                total = row if total is None else total + row
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["s"])

        parts = self.state.select("x", "y", "w", "held").mapInArrow(partial, "s array<double>")
        sums = parts.select(F.posexplode("s").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()
        return np.array([r["v"] for r in sums])  # bounded by the feature count

    def _linear_round(self) -> None:
        s = self._pass() if self._sums is None else self._sums
        if not len(s):
            self.history.append((self.rounds + 1, None, None))
            return
        n = self.dim + 1
        g, gram = s[4:4 + n].copy(), s[4 + n:].reshape(-1, n)
        l1, l2 = self.l1 * s[1], self.l2 * s[1]  # penalties count a unit of weight
        cross, curve = (gram[0], np.diag(gram)) if self.updater == "cyclic" else gram
        step = float(-self.eta * g[0] / curve[0]) if curve[0] else 0.0
        self.bias += step
        g += cross * step
        for j in range(1, n):
            move = self.eta * soft_step(g[j], curve[j], self.coef[j - 1], l1, l2)
            self.coef[j - 1] += float(move)
            if self.updater == "cyclic":
                g += gram[j] * move
        self._sums = s = self._pass()
        self.history.append((self.rounds + 1, *(float(a / b) if b else None for a, b in (s[0:2], s[2:4]))))


def fit_booster(rows: DataFrame, label: str, features: Sequence[str], booster: str = "gbtree", rounds: int = 10,
                stop_after: int | None = None, **params) -> BoosterModel:
    """Fit a booster of one kind (G1): ``gbtree``, ``gblinear`` or ``dart``.

    With ``valid`` (a boolean column) and ``stop_after``, boosting ends when the validation loss has
    not fallen for so many rounds (G16). ``params``: see ``Boosting``.
    """
    fit = Boosting(rows, label, features, booster, **params)
    best, since = math.inf, 0
    for _ in range(rounds):
        fit.grow(1)
        loss = fit.history[-1][2]
        best, since = (loss, 0) if loss is not None and loss < best else (best, since + 1)
        if stop_after and loss is not None and since >= stop_after:
            break
    return fit.model()
