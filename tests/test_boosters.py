"""Boosters against numpy versions, tree attributions against enumeration over feature subsets."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from kestrel.operators.boosters import Boosting, draw_dropped, fit_booster, load_booster
from kestrel.operators.trees import explain_trees, goes_left, read_trees
from kestrel.session import scratch_path

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data():
    """Few distinct values a feature, so that Spark's bins hold every threshold."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 9, (300, 3)).astype(float)
    logit = 0.8 * (x[:, 0] > 4) * (x[:, 1] - 4) - 0.3 * x[:, 2] + 1
    y = (rng.random(300) < 1 / (1 + np.exp(-logit))).astype(float)
    return x, y, rng.random(300) + 0.5, np.arange(300) % 5 == 0


@pytest.fixture(scope="module")
def rows(spark, data):
    x, y, w, held = data
    return spark.createDataFrame([(i, *map(float, x[i]), float(y[i]), float(w[i]), bool(held[i])) for i in range(len(y))],
                                 "id long, a double, b double, c double, label double, w double, held boolean").cache()


def logloss(m, y, w):
    return float((w * np.logaddexp(0, np.where(y > 0.5, -m, m))).sum() / w.sum())


def grow_tree(x, t, h, depth):
    """Weighted regression tree of largest variance gain; returns a function to a leaf's path."""
    def build(rows, left):
        best = (1e-9, None)
        for f in range(x.shape[1]) if left else ():
            values = np.unique(x[rows, f])
            for cut in (values[1:] + values[:-1]) / 2:
                a = x[rows, f] <= cut
                score = sum((h[r] * t[r]).sum() ** 2 / h[r].sum() for r in (rows[a], rows[~a]))
                gain = score - (h[rows] * t[rows]).sum() ** 2 / h[rows].sum()
                if gain > best[0] + 1e-9:
                    best = (gain, (f, cut))
        if best[1] is None:
            return None
        f, cut = best[1]
        a = x[rows, f] <= cut
        return (f, cut, build(rows[a], left - 1), build(rows[~a], left - 1))

    tree = build(np.arange(len(x)), depth)

    def leaf(row):
        node, path = tree, ""
        while node:
            go = row[node[0]] <= node[1]
            node, path = node[2 if go else 3], path + "lr"[not go]
        return path

    return leaf


def numpy_dart(x, y, w, held, rounds, eta, l2, depth, rate, skip, one, seed):
    rng, outs, weights, history = random.Random(seed), [], [], []
    for _ in range(rounds):
        dropped = draw_dropped(rng, len(outs), rate, skip, one)
        m = sum((wt * o for i, (wt, o) in enumerate(zip(weights, outs)) if i not in dropped), np.zeros(len(y)))
        p = 1 / (1 + np.exp(-m))
        g, h = w * (p - y), w * p * (1 - p)
        t = ~held
        leaf = grow_tree(x[t], -(g / h)[t], h[t], depth)
        paths = np.array([leaf(r) for r in x])
        value = {s: -g[t & (paths == s)].sum() / (h[t & (paths == s)].sum() + l2) for s in set(paths[t])}
        outs.append(np.array([value[s] for s in paths]))
        k = len(dropped)
        for i in dropped:
            weights[i] *= k / (k + eta)
        weights.append(eta / (k + eta) if k else eta)
        m = sum(wt * o for wt, o in zip(weights, outs))
        history.append((logloss(m[t], y[t], w[t]), logloss(m[held], y[held], w[held])))
    return m, weights, history


@pytest.mark.parametrize("kind,drop", [("gbtree", (0.0, 0.0, False)), ("dart", (0.4, 0.2, True))])
def test_tree_boosters_equal_numpy(data, rows, kind, drop):
    x, y, w, held = data
    extra = dict(zip(("rate_drop", "skip_drop", "one_drop"), drop)) if kind == "dart" else {}
    fit = Boosting(rows, "label", NAMES, kind, weight="w", valid="held", seed=5, max_depth=2, **extra).grow(4)
    m, weights, history = numpy_dart(x, y, w, held, 4, 0.3, 1.0, 2, *drop, 5)
    assert fit.weights == pytest.approx(weights)
    assert [h[1:] for h in fit.history] == [pytest.approx(h) for h in history]
    got = fit.model().transform(rows).orderBy("id").collect()
    assert [r["margin"] for r in got] == pytest.approx(m.tolist())
    assert [r["score"] for r in got] == pytest.approx((1 / (1 + np.exp(-m))).tolist())
    if kind == "dart":
        assert min(fit.weights) < 0.3  # something was dropped and scaled


def test_stored_outputs_change_nothing(rows, monkeypatch):
    import kestrel.operators.boosters as bo
    args = dict(booster="dart", rounds=4, seed=2, max_depth=2, rate_drop=0.5)
    plain = fit_booster(rows, "label", NAMES, **args)
    monkeypatch.setattr(bo, "FRESH_TREES", 2)
    stored = fit_booster(rows, "label", NAMES, **args)
    assert stored.weights == plain.weights
    assert all((a.value == pytest.approx(b.value)) for a, b in zip(stored.trees, plain.trees))


@pytest.mark.parametrize("objective", ["logistic", "squared"])
@pytest.mark.parametrize("updater,eta", [("cyclic", 0.5), ("parallel", 0.1)])
def test_linear_booster_equals_numpy(data, rows, objective, updater, eta):
    x, y, w, held = data
    t, l1, l2 = ~held, 0.003, 0.02
    fit = Boosting(rows, "label", NAMES, "gblinear", objective=objective, weight="w", valid="held", eta=eta, l1=l1, l2=l2,
                   updater=updater).grow(7)
    bias, coef, total = 0.0, np.zeros(3), w[t].sum()
    for _ in range(7):
        m = bias + x[t] @ coef
        p = 1 / (1 + np.exp(-m)) if objective == "logistic" else m
        g = w[t] * (p - y[t])
        h = w[t] * (p * (1 - p) if objective == "logistic" else 1)
        step = -eta * g.sum() / h.sum()
        bias += step
        g = g + h * step
        moves = np.zeros(3)
        for j in range(3):
            sg, sh = (g * x[t][:, j]).sum(), (h * x[t][:, j] ** 2).sum()
            grid = [-coef[j]]  # the minimum of the penalised parabola: at zero or where a side's slope vanishes
            for side in (1, -1):
                d = -(sg + l2 * total * coef[j] + side * l1 * total) / (sh + l2 * total)
                if (coef[j] + d) * side > 0:
                    grid.append(d)
            cost = [sg * d + sh * d * d / 2 + l2 * total * (coef[j] + d) ** 2 / 2 + l1 * total * abs(coef[j] + d)
                    for d in grid]
            moves[j] = eta * grid[int(np.argmin(cost))]
            if updater == "cyclic":
                coef[j] += moves[j]
                g = g + h * x[t][:, j] * moves[j]
        if updater == "parallel":
            coef += moves
    assert fit.bias == pytest.approx(bias) and fit.coef == pytest.approx(coef.tolist())
    if objective == "logistic":
        m = bias + x @ coef
        assert fit.history[-1][1:] == pytest.approx((logloss(m[t], y[t], w[t]), logloss(m[held], y[held], w[held])))


def test_early_stop_save_and_edges(spark, rows):
    model = fit_booster(rows, "label", NAMES, "gbtree", rounds=40, stop_after=2, valid="held", max_depth=4, eta=1.0)
    assert 1 <= len(model.trees) < 40
    for kind in ("gbtree", "gblinear"):
        model = fit_booster(rows, "label", NAMES, kind, rounds=2, max_depth=2)
        path = scratch_path(spark, "booster")
        model.save(spark, path)
        a, b = (m.transform(rows).agg(F.sum("margin")).first()[0] for m in (model, load_booster(spark, path)))
        assert a == b
    with pytest.raises(ValueError):
        Boosting(rows, "label", NAMES, "forest")
    holes = rows.withColumn("label", F.when(F.col("id") % 3 > 0, F.col("label")))
    assert fit_booster(holes, "label", NAMES, "gblinear", rounds=1).coef == pytest.approx(
        fit_booster(holes.where("label is not null"), "label", NAMES, "gblinear", rounds=1).coef)


def test_boosting_continues(rows):
    once = Boosting(rows, "label", NAMES, "dart", rate_drop=0.5, seed=1, max_depth=2).grow(3)
    twice = Boosting(rows, "label", NAMES, "dart", rate_drop=0.5, seed=1, max_depth=2).grow(1).grow(2)
    assert once.weights == twice.weights and once.history == twice.history


# -- attributions

def expected(tree, row, known, node=0):
    """The tree's output when only the features in ``known`` are given; the others follow the cover."""
    if tree.feature[node] < 0:
        return tree.value[node]
    left, right = tree.left[node], tree.right[node]
    if tree.feature[node] in known:
        go = goes_left(tree, node, row[None, :])[0]
        return expected(tree, row, known, left if go else right)
    return sum(tree.cover[c] / tree.cover[node] * expected(tree, row, known, c) for c in (left, right))


def enumerated(trees, weights, row, d):
    out = np.zeros(d)
    for j in range(d):
        others = [k for k in range(d) if k != j]
        for size in range(d):
            share = math.factorial(size) * math.factorial(d - 1 - size) / math.factorial(d)
            for s in itertools.combinations(others, size):
                out[j] += share * sum(w * (expected(t, row, {*s, j}) - expected(t, row, set(s)))
                                      for t, w in zip(trees, weights))
    return out


@pytest.mark.parametrize("kind", ["gbt", "forest", "tree", "categories"])
def test_attributions_equal_enumeration(spark, rows, data, kind):
    x = data[0]
    vec = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)
    cls = None
    if kind == "gbt":
        model = GBTClassifier(labelCol="label", maxIter=3, maxDepth=3, seed=1).fit(vec)
    elif kind == "forest":
        model, cls = RandomForestClassifier(labelCol="label", numTrees=4, maxDepth=3, seed=1).fit(vec), 1
    else:
        if kind == "categories":  # a categorical feature splits by sets
            from pyspark.ml.feature import StringIndexer
            named = rows.withColumn("s", F.concat(F.lit("v"), F.col("a").cast("int")))
            named = StringIndexer(inputCol="s", outputCol="a2", stringOrderType="alphabetAsc").fit(named).transform(named)
            vec = VectorAssembler(inputCols=["a2", "b", "c"], outputCol="features").transform(named)
        model = DecisionTreeRegressor(labelCol="label", weightCol="w", maxDepth=4, seed=1).fit(vec)
    trees = read_trees(model, spark, cls)
    weights = list(getattr(model, "treeWeights", [1.0]))
    if kind == "forest":
        weights = [0.25] * 4
    if kind == "categories":
        assert any(t.left_set for t in trees)
    out = explain_trees(model, vec, cls=cls).orderBy("id").collect()
    known = model.transform(vec).orderBy("id").collect()
    for i, (r, k) in enumerate(zip(out, known)):
        assert r["base"] + sum(r["contrib"]) == pytest.approx(r["output"], abs=1e-9)
        raw = {"gbt": lambda k: k["rawPrediction"][1], "forest": lambda k: k["probability"][1]}.get(
            kind, lambda k: k["prediction"])(k)
        assert r["output"] == pytest.approx(raw, abs=1e-9)
        if i % 25 == 0:
            assert r["contrib"] == pytest.approx(enumerated(trees, weights, np.array(x[i]), 3).tolist(), abs=1e-9)


def test_booster_attributions_add_up(rows):
    for kind in ("dart", "gblinear"):
        model = fit_booster(rows, "label", NAMES, kind, rounds=3, max_depth=3)
        for r in model.explain(rows).collect():
            assert r["base"] + sum(r["contrib"]) == pytest.approx(r["margin"], abs=1e-9)
