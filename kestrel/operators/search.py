"""Adaptive parameter search with early-stopped trials.

Each trial's parameters are proposed from the earlier ones by Parzen estimators: the best quarter
of the trials gives a density l, the others a density g, for each parameter on its own; of a few
draws from l the one with the largest l/g is tried. A trial grows a boosted fit from rung to rung
and goes on only while its validation loss is among the best third of all losses seen at that
rung, so weak trials cost few rounds.

The search itself handles a handful of trials on the driver; every fit and every loss is a Spark
job over all rows.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame

from .boosters import BoosterModel, Boosting
from .ml import sample_param_maps

#: Random trials before the first proposal; share of good trials; draws of a proposal; a third goes on at a rung.
STARTUP, GOOD, DRAWS, GO_ON = 4, 0.25, 24, 3


def _normal_cdf(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


class Parzen:
    """Density of one parameter from the values tried so far.

    ``float`` and ``log`` (on the logarithm): an even mixture of the uniform density over the range
    and, for each value, a normal one cut to the range, as wide as the gap to its farther
    neighbour (ends of the range count as neighbours), but at least range / min(100, values + 1).
    ``int``: the same over [lo - 1/2, hi + 1/2], summed over each whole number's cell. ``choice``:
    (times tried + 1 / choices) / (values + 1).
    """

    def __init__(self, spec: tuple, values: Sequence):
        self.kind, self.spec = spec[0], spec
        if self.kind not in ("int", "float", "log", "choice"):
            raise ValueError(f"unknown space kind {self.kind}")
        if self.kind == "choice":
            self.choices = list(spec[1])
            self.weight = [(sum(v == c for v in values) + 1 / len(self.choices)) / (len(values) + 1) for c in self.choices]
            return
        lo, hi = (float(spec[1]), float(spec[2]))
        if self.kind == "int":
            lo, hi = lo - 0.5, hi + 0.5
        elif self.kind == "log":
            lo, hi = math.log(lo), math.log(hi)
        self.lo, self.hi = lo, hi
        self.centres = sorted(math.log(v) if self.kind == "log" else float(v) for v in values)
        around = [lo, *self.centres, hi]
        least = (hi - lo) / min(100, len(self.centres) + 1)
        self.widths = [min(hi - lo, max(c - around[i], around[i + 2] - c, least)) for i, c in enumerate(self.centres)]

    def _below(self, x: float) -> float:
        """Share of the density below x (numeric kinds)."""
        x = min(max(x, self.lo), self.hi)
        total = (x - self.lo) / (self.hi - self.lo)
        for c, s in zip(self.centres, self.widths, strict=True):
            a, b = _normal_cdf((self.lo - c) / s), _normal_cdf((self.hi - c) / s)
            total += (_normal_cdf((x - c) / s) - a) / (b - a)
        return total / (len(self.centres) + 1)

    def density(self, value) -> float:
        if self.kind == "choice":
            return self.weight[self.choices.index(value)]
        if self.kind == "int":
            return self._below(value + 0.5) - self._below(value - 0.5)
        x = math.log(value) if self.kind == "log" else float(value)
        total = 1 / (self.hi - self.lo)
        for c, s in zip(self.centres, self.widths, strict=True):
            inside = _normal_cdf((self.hi - c) / s) - _normal_cdf((self.lo - c) / s)
            total += math.exp(-((x - c) / s) ** 2 / 2) / (s * math.sqrt(2 * math.pi) * inside)
        return total / (len(self.centres) + 1)

    def draw(self, rng: random.Random):
        if self.kind == "choice":
            return rng.choices(self.choices, self.weight)[0]
        i = rng.randrange(len(self.centres) + 1)
        x = rng.uniform(self.lo, self.hi)
        while i < len(self.centres):
            x = rng.gauss(self.centres[i], self.widths[i])
            if self.lo <= x <= self.hi:
                break
        if self.kind == "int":
            return min(max(round(x), self.spec[1]), self.spec[2])
        return min(max(math.exp(x), self.spec[1]), self.spec[2]) if self.kind == "log" else x


class Trial(NamedTuple):
    params: dict
    rounds: int
    loss: float
    stopped: bool


def split_trials(trials: Sequence[Trial]) -> tuple[list[Trial], list[Trial]]:
    """The best quarter (at least one) and the rest: more rounds before fewer, then by loss."""
    order = sorted(trials, key=lambda t: (t.stopped, -t.rounds if t.stopped else 0, t.loss))
    n = max(1, math.ceil(GOOD * len(order)))
    return order[:n], order[n:]


def propose(space: Mapping[str, tuple], trials: Sequence[Trial], rng: random.Random) -> dict:
    """The draw from the good trials' density with the largest ratio to the others' density."""
    good, rest = split_trials(trials)
    l = {k: Parzen(s, [t.params[k] for t in good]) for k, s in space.items()}  # noqa: E741
    g = {k: Parzen(s, [t.params[k] for t in rest]) for k, s in space.items()}
    draws = [{k: l[k].draw(rng) for k in space} for _ in range(DRAWS)]
    return max(draws, key=lambda d: sum(math.log(l[k].density(v)) - math.log(g[k].density(v)) for k, v in d.items()))


def goes_on(losses: Sequence[float], loss: float) -> bool:
    """Whether a loss is among the best third (at least one) of the losses at a rung, itself among them."""
    return sum(x < loss for x in losses) < math.ceil(len(losses) / GO_ON)


class Search(NamedTuple):
    best: BoosterModel
    trials: list
    rounds_fitted: int

    def table(self, spark) -> DataFrame:
        """One row a trial: (trial, params, rounds, loss, stopped, best); params as JSON."""
        winner = best_trial(self.trials)
        rows = [(i, json.dumps(t.params, sort_keys=True), t.rounds, t.loss, t.stopped, i == winner)
                for i, t in enumerate(self.trials)]
        return spark.createDataFrame(rows, "trial int, params string, rounds int, loss double, stopped boolean, best boolean")


def best_trial(trials: Sequence[Trial]) -> int:
    """Number of the trial with the least loss; the first one wins ties."""
    return min(range(len(trials)), key=lambda i: trials[i].loss)


def adaptive_search(rows: DataFrame, label: str, features: Sequence[str], space: Mapping[str, tuple], trials: int,
                    valid: str, rungs: Sequence[int] = (1, 3, 9, 27), seed: int = 0, early_stop: bool = True,
                    **fixed) -> Search:
    """Search boosted fits over a declared space (see ``sample_param_maps`` for its kinds).

    ``rounds`` in the space or in ``fixed`` is a trial's number of rounds; the other names are
    parameters of ``Boosting``. ``valid`` is the boolean column of the validation rows. Every rung below a
    trial's rounds may stop it; without ``early_stop`` none does.
    """
    rng = random.Random(seed)
    start = sample_param_maps(space, min(STARTUP, trials), seed)
    done: list[Trial] = []
    seen: dict[int, list[float]] = {}
    best, least, fitted = None, math.inf, 0
    for i in range(trials):
        params = start[i] if i < len(start) else propose(space, done, rng)
        settings = {**fixed, **params}
        rounds = int(settings.pop("rounds"))
        fit = Boosting(rows, label, features, valid=valid, seed=seed, **settings)
        stopped = False
        for rung in [*[r for r in rungs if early_stop and r < rounds], rounds]:
            fit.grow(rung - fit.rounds)
            loss = fit.history[-1][2]
            if loss is None:
                raise ValueError("no validation rows")
            if rung < rounds:
                seen.setdefault(rung, []).append(loss)
                if not goes_on(seen[rung], loss):
                    stopped = True
                    break
        fitted += fit.rounds
        done.append(Trial(params, fit.rounds, loss, stopped))
        if loss < least:
            best, least = fit.model(), loss
    return Search(best, done, fitted)
