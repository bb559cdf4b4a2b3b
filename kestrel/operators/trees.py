"""Fitted decision trees as plain arrays: reading them from Spark ML models, scoring, and
attributions (G14).

A fitted model is bounded by its own size (trees x nodes), never by the data, so its nodes are
read to the driver once and travel with the scoring tasks; rows are scored in Arrow batches.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


class Tree(NamedTuple):
    """Nodes in pre-order; ``feature`` is -1 at leaves. A row goes left when its value is at most
    the threshold, or, at a node with ``left_set``, when its category is in that set."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    left_set: dict


def _nodes(model, spark) -> list:
    """Node rows of a saved tree model, one list a tree."""
    path = scratch_path(spark, "tree-model")
    model.write().save(path)
    saved = spark.read.parquet(f"{path}/data")
    if "treeID" in saved.columns:
        saved = saved.select("treeID", "nodeData.*")
    else:
        saved = saved.withColumn("treeID", F.lit(0))
    by: dict = {}
    for r in saved.collect():  # the model itself: trees x nodes
        by.setdefault(r["treeID"], []).append(r)
    return [sorted(by[t], key=lambda r: r["id"]) for t in sorted(by)]


def read_trees(model, spark, cls: int | None = None) -> list[Tree]:
    """Trees of a fitted Spark ML tree model or ensemble.

    ``cls``: for classification trees, the value of a node is the share of this class among its
    training rows; otherwise the node's prediction. ``cover`` is the weight of its training rows.
    """
    out = []
    for rows in _nodes(model, spark):
        where = {r["id"]: i for i, r in enumerate(rows)}
        n = len(rows)
        tree = Tree(np.full(n, -1), np.zeros(n), np.full(n, -1), np.full(n, -1), np.zeros(n), np.zeros(n), {})
        for i, r in enumerate(rows):
            stats = r["impurityStats"]
            if cls is None:
                tree.value[i], tree.cover[i] = r["prediction"], stats[0] if len(stats) == 3 else sum(stats)
            else:
                tree.value[i], tree.cover[i] = stats[cls] / sum(stats), sum(stats)
            if r["leftChild"] >= 0:
                split = r["split"]
                tree.feature[i] = split["featureIndex"]
                tree.left[i], tree.right[i] = where[r["leftChild"]], where[r["rightChild"]]
                if split["numCategories"] == -1:
                    tree.threshold[i] = split["leftCategoriesOrThreshold"][0]
                else:
                    tree.left_set[i] = frozenset(split["leftCategoriesOrThreshold"])
        out.append(tree)
    return out


def grown_tree(model) -> Tree:
    """The tree of a fitted Spark ML decision tree model, read node by node; the covers are left at 0."""
    nodes: list = []

    def add(node) -> int:
        at = len(nodes)
        nodes.append(None)
        if node.getClass().getSimpleName() == "LeafNode":
            nodes[at] = (-1, 0.0, -1, -1, node.prediction(), None)
            return at
        split = node.split()
        ordered = split.getClass().getSimpleName() == "ContinuousSplit"
        some = None if ordered else frozenset(split.leftCategories())
        left, right = add(node.leftChild()), add(node.rightChild())
        nodes[at] = (split.featureIndex(), split.threshold() if ordered else 0.0, left, right, node.prediction(), some)
        return at

    add(model._java_obj.rootNode())
    columns = [np.array(c) for c in zip(*[n[:5] for n in nodes], strict=True)]
    return Tree(*columns, np.zeros(len(nodes)), {i: n[5] for i, n in enumerate(nodes) if n[5] is not None})


def set_covers(tree: Tree, weight: dict) -> None:
    """Fill in the covers from the weight of each leaf's rows."""
    for node in range(len(tree.feature) - 1, -1, -1):  # children come behind their parents
        if tree.feature[node] < 0:
            tree.cover[node] = weight.get(node, 0.0)
        else:
            tree.cover[node] = tree.cover[tree.left[node]] + tree.cover[tree.right[node]]


def goes_left(tree: Tree, node: int, x: np.ndarray) -> np.ndarray:
    """Which rows go left at a node."""
    column = x[:, tree.feature[node]]
    if node in tree.left_set:
        return np.isin(column, list(tree.left_set[node]))
    return column <= tree.threshold[node]


def leaves(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf that each row ends in."""
    at = np.zeros(len(x), np.int64)
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if tree.feature[node] < 0:
            at[rows] = node
        elif len(rows):
            left = goes_left(tree, node, x[rows])
            todo += [(tree.left[node], rows[left]), (tree.right[node], rows[~left])]
    return at


def matrix(rows: pd.Series) -> np.ndarray:
    """A batch of feature arrays as a matrix."""
    return np.array(rows.tolist(), float).reshape(len(rows), -1)


def tree_outputs(trees: Sequence[Tree], x: Column) -> Column:
    """Array of every tree's value for a feature array column."""
    @F.pandas_udf("array<double>")
    def outputs(rows: pd.Series) -> pd.Series:
        m = matrix(rows)
        return pd.Series(list(np.stack([t.value[leaves(t, m)] for t in trees], axis=1)), dtype=object)

    return outputs(x) if trees else F.array().cast("array<double>")


def mean_value(tree: Tree) -> float:
    """Mean leaf value, by training weight."""
    ends = tree.feature < 0
    return float((tree.value[ends] * tree.cover[ends]).sum() / tree.cover[ends].sum())


def _paths(tree: Tree) -> list:
    """(leaf, [(node, went left)]) of each leaf."""
    out, todo = [], [(0, [])]
    while todo:
        node, path = todo.pop()
        if tree.feature[node] < 0:
            out.append((node, path))
        else:
            todo += [(tree.left[node], [*path, (node, True)]), (tree.right[node], [*path, (node, False)])]
    return out


def shapley(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Shapley values (rows x features) of a tree, with features left out following the training weights.

    The game: a coalition's value is the tree's expected output when features outside of it take
    both branches in proportion to the cover. A leaf with value v reached over the features
    1..m pays v * prod_k f_k, where f_k is 1 or 0 (the row agrees with all of the path's tests of
    k) for features of the coalition and the product of cover shares for the others; so its
    Shapley value for j is v (o_j - z_j) sum_s w_s [t^s] prod_{k <> j} (z_k + o_k t).
    """
    out = np.zeros(x.shape)
    for leaf, path in _paths(tree):
        agree: dict = {}
        share: dict = {}
        for node, left in path:
            f = int(tree.feature[node])
            ok = goes_left(tree, node, x) == left
            agree[f] = agree[f] & ok if f in agree else ok
            child = tree.left[node] if left else tree.right[node]
            share[f] = share.get(f, 1.0) * tree.cover[child] / tree.cover[node]
        features, m = list(agree), len(agree)
        weight = [math.factorial(s) * math.factorial(m - 1 - s) / math.factorial(m) for s in range(m)]
        for j in features:
            poly = [np.ones(len(x))]
            for k in features:
                if k != j:
                    o = agree[k].astype(float)
                    low = [c * share[k] for c in poly]
                    poly = [a + b for a, b in zip([*low, 0.0], [0.0, *[c * o for c in poly]], strict=True)]
            total = sum(w * c for w, c in zip(weight, poly, strict=True))
            out[:, j] += tree.value[leaf] * (agree[j] - share[j]) * total
    return out


def contributions(trees: Sequence[Tree], weights: Sequence[float], x: Column) -> Column:
    """Array of the weighted trees' Shapley values, one a feature, for a feature array column."""
    @F.pandas_udf("array<double>")
    def explain(rows: pd.Series) -> pd.Series:
        m = matrix(rows)
        total = np.zeros(m.shape)
        for t, w in zip(trees, weights, strict=True):
            total += w * shapley(t, m)
        return pd.Series(list(total), dtype=object)

    return explain(x)


def explain_trees(model, df: DataFrame, features: str = "features", cls: int | None = None) -> DataFrame:
    """Per-row attributions of a fitted Spark ML tree model (G14): columns ``contrib`` (one value a
    feature), ``base`` (the mean output over the training rows) and ``output``; base + sum(contrib)
    = output for every row.

    The output is the margin of a boosted classifier, the prediction of a regression, or with
    ``cls`` the mean class share of a forest or tree.
    """
    trees = read_trees(model, df.sparkSession, cls)
    weights = list(getattr(model, "treeWeights", [1.0]))
    if cls is not None and len(trees) > 1 or type(model).__name__ == "RandomForestRegressionModel":
        weights = [w / sum(weights) for w in weights]
    x = vector_to_array(F.col(features))
    parts = F.zip_with(tree_outputs(trees, x), F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b)
    base = sum(w * mean_value(t) for t, w in zip(trees, weights, strict=True))
    return df.select("*", contributions(trees, weights, x).alias("contrib"), F.lit(base).alias("base"),
                     F.aggregate(parts, F.lit(0.0), lambda a, b: a + b).alias("output"))
