from collections import defaultdict
from fractions import Fraction

import pytest

import kestrel.llm.mixing as m
from kestrel.llm.mixing import mix

from .helpers import documents


def fill(sizes, weights, epochs):
    """Targets by repeated resharing, in exact arithmetic."""
    total, target, open_ = sum(sizes.values()), {}, list(sizes)
    left = Fraction(total)
    while open_:
        w = sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / w >= epochs * sizes[s]]
        if not over:
            target |= {s: left * weights[s] / w for s in open_}
            break
        for s in over:
            target[s] = Fraction(epochs * sizes[s])
        left -= sum(target[s] for s in over)
        open_ = [s for s in open_ if s not in over]
    return target


@pytest.mark.parametrize("per_range", [2048, 3])
def test_targets_and_budgets(spark, monkeypatch, per_range):
    monkeypatch.setattr(m, "ROWS_PER_RANGE", per_range)
    rows = [(i, "w " * (i % 23), "en", "abcde"[min(4, i % 11)]) for i in range(300)]
    rows += [(1000 + i, "x y\tz", "en", None) for i in range(4)] + [(2000, "", "en", "zero"), (2001, None, "en", "zero")]
    got = mix(documents(spark, rows)).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s))
    want = fill(sizes, {s: 1 + i % 3 for i, s in enumerate(order)}, 3)
    taken = defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size and r.source_size == sizes[r.source]
        assert abs(r.target - float(want[r.source])) < 1e-6 * max(1.0, r.target)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= Fraction(1, 2)
    again = mix(documents(spark, rows).repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in got)


def test_edges(spark):
    rows = [(None, "a b", "en", "s"), (3, "c", "en", "s"), (3, "c", "en", "s"), (4, "d e f", "en", None)]
    got = mix(documents(spark, rows, ["size", "taken", "key", "rest"])).collect()
    assert len(got) == 4 and sum(r.taken for r in got) == 7
    assert mix(documents(spark, rows).limit(0)).count() == 0
    assert [r.taken for r in mix(documents(spark, [(1, None), (2, " ")])).collect()] == [0, 0]
