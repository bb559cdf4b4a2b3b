"""Proposals follow the written density, weak trials stop early, the best trial is reported."""

import json
import math
import random

import numpy as np
import pytest

from kestrel.operators.search import Parzen, Trial, adaptive_search, best_trial, goes_on, propose, split_trials


def normal(x, c, s):
    return math.exp(-((x - c) / s) ** 2 / 2) / (s * math.sqrt(2 * math.pi))


def test_float_density_is_the_written_mixture():
    p = Parzen(("float", 0.0, 10.0), [2.0, 3.0])
    # farther neighbours: 2 -> max(2, 1), 3 -> max(1, 7); least width 10 / 3
    widths = [10 / 3, 7.0]
    def cut(c, s):
        return 0.5 * (math.erf((10 - c) / s / math.sqrt(2)) - math.erf(-c / s / math.sqrt(2)))
    for x in (0.0, 1.5, 2.0, 9.9):
        want = (0.1 + sum(normal(x, c, s) / cut(c, s) for c, s in zip([2.0, 3.0], widths))) / 3
        assert p.density(x) == pytest.approx(want)


@pytest.mark.parametrize("spec,values", [(("float", -1.0, 3.0), [0.0, 2.9, 2.9]), (("log", 1e-4, 10.0), [0.01]),
                                         (("int", 2, 7), [2, 5, 5]), (("choice", ["a", "b", "c"]), ["a", "a"])])
def test_densities_sum_to_one_and_draws_follow_them(spec, values):
    p, rng = Parzen(spec, values), random.Random(4)
    draws = [p.draw(rng) for _ in range(20_000)]
    if spec[0] in ("int", "choice"):
        cells = list(range(spec[1], spec[2] + 1)) if spec[0] == "int" else spec[1]
        shares = [p.density(c) for c in cells]
        assert sum(shares) == pytest.approx(1)
        got = [sum(d == c for d in draws) / len(draws) for c in cells]
    else:
        to = math.log if spec[0] == "log" else float
        edges = np.linspace(to(spec[1]), to(spec[2]), 9)
        grid = np.linspace(edges[0], edges[-1], 8001)
        back = math.exp if spec[0] == "log" else float
        mids = (grid[1:] + grid[:-1]) / 2
        mass = np.array([p.density(back(m)) for m in mids]) * np.diff(grid)
        assert mass.sum() == pytest.approx(1, abs=1e-4)
        shares = mass.reshape(8, -1).sum(axis=1)
        got = np.histogram([to(d) for d in draws], edges)[0] / len(draws)
    assert np.abs(np.array(got) - shares).max() < 0.015


def test_choice_density():
    p = Parzen(("choice", ["x", "y"]), ["x", "x", "y"])
    assert [p.density(c) for c in "xy"] == pytest.approx([2.5 / 4, 1.5 / 4])


def objective(depth, eta, kind):
    return (depth - 6) ** 2 + 9 * (eta - 0.3) ** 2 + (kind != "b")


def fixed_trials():
    rng = random.Random(1)
    out = []
    for _ in range(40):
        depth, eta, kind = rng.randint(2, 9), rng.uniform(0, 1), rng.choice(["a", "b", "c"])
        out.append(Trial({"depth": depth, "eta": eta, "kind": kind}, 9, objective(depth, eta, kind), False))
    return out


def test_proposals_move_to_the_good_trials():
    space = {"depth": ("int", 2, 9), "eta": ("float", 0.0, 1.0), "kind": ("choice", ["a", "b", "c"])}
    picks = [propose(space, fixed_trials(), random.Random(s)) for s in range(30)]
    assert all(2 <= p["depth"] <= 9 and 0 <= p["eta"] <= 1 for p in picks)
    rng = random.Random(0)
    anywhere = [{"depth": rng.randint(2, 9), "eta": rng.uniform(0, 1), "kind": rng.choice("abc")} for _ in range(2000)]
    assert np.mean([objective(**p) for p in picks]) < 0.35 * np.mean([objective(**p) for p in anywhere])


def test_the_pick_has_the_largest_ratio():
    space, trials = {"eta": ("float", 0.0, 1.0)}, fixed_trials()
    good, rest = split_trials(trials)
    assert len(good) == 10 and max(t.loss for t in good) <= min(t.loss for t in rest)
    l, g = (Parzen(space["eta"], [t.params["eta"] for t in part]) for part in (good, rest))
    rng = random.Random(3)
    draws = [l.draw(rng) for _ in range(24)]
    assert propose(space, trials, random.Random(3))["eta"] == max(draws, key=lambda x: l.density(x) / g.density(x))


def test_stopped_trials_rank_behind():
    trials = [Trial({}, 1, 0.1, True), Trial({}, 3, 0.2, True), Trial({}, 9, 0.5, False)]
    assert split_trials(trials)[0] == [trials[2]]
    assert best_trial(trials) == 0
    assert goes_on([0.3], 0.3) and not goes_on([0.3, 0.4], 0.4)
    assert goes_on([0.1, 0.2, 0.3, 0.4], 0.2) and not goes_on([0.1, 0.2, 0.3, 0.4], 0.3)


def test_search_over_spark_fits(spark):
    rng = np.random.default_rng(0)
    x = rng.integers(0, 8, (240, 2)).astype(float)
    y = ((x[:, 0] > 3) ^ (x[:, 1] > 3)).astype(float)  # no linear model separates this
    rows = spark.createDataFrame([(float(a), float(b), float(c), bool(i % 3 == 0)) for i, ((a, b), c) in
                                  enumerate(zip(x, y))], "a double, b double, label double, held boolean").cache()
    space = {"booster": ("choice", ["gbtree", "gblinear"]), "max_depth": ("int", 1, 3), "rounds": ("int", 3, 4),
             "eta": ("float", 0.2, 0.9)}
    args = (rows, "label", ["a", "b"], space, 5, "held")
    found = adaptive_search(*args, rungs=(1, 2), seed=3)
    table = found.table(spark).orderBy("trial").collect()
    assert len(table) == 5 and sum(r["best"] for r in table) == 1
    winner = next(r for r in table if r["best"])
    assert winner["loss"] == min(r["loss"] for r in table)
    assert json.loads(winner["params"])["booster"] == "gbtree" == found.best.booster
    stopped = [r for r in table if r["stopped"]]
    assert stopped and all(r["rounds"] in (1, 2) for r in stopped)
    assert found.rounds_fitted == sum(r["rounds"] for r in table) < sum(
        json.loads(r["params"])["rounds"] for r in table)
    # each loss is the one its model has on the validation rows
    m = found.best.transform(rows.where("held")).collect()
    assert winner["loss"] == pytest.approx(np.mean([np.logaddexp(0, -r["margin"] if r["label"] else r["margin"]) for r in m]))
