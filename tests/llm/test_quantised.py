import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import kestrel.llm.quantised as qz
from kestrel.llm.quantised import learn_index, learn_rotation, near_vectors, pairs_at

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def brute(rows, cosine=0.95):
    """{row number: (vec_id, n_links, component_id, kept)} by comparing all pairs."""
    good = {}
    for n, (i, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            if x.any():
                good[n] = x / np.linalg.norm(x)
    links = {n: set() for n in range(len(rows))}
    by_dim = {}
    for n, x in good.items():
        by_dim.setdefault(len(x), []).append(n)
    for members in by_dim.values():
        m = np.stack([good[n] for n in members])
        for k, row in enumerate(m @ m.T >= cosine):
            links[members[k]] |= {members[j] for j in np.flatnonzero(row)} - {members[k]}
    comp, out = {}, []
    for n in range(len(rows)):
        if n in comp:
            continue
        group, todo = {n}, [n]
        while todo:
            new = links[todo.pop()] - group
            group |= new
            todo += new
        ids = [rows[g][0] for g in group if rows[g][0] is not None]
        comp.update(dict.fromkeys(group, min(ids) if ids else None))
    for n, (i, _) in enumerate(rows):
        out.append((i, len(links[n]), comp[n], i == comp[n]))
    return sorted(out, key=repr)


def got(df, **kw):
    return sorted(map(tuple, near_vectors(df, **kw).collect()), key=repr)


def clusters(seed, singles, groups, dim=24):
    """Vectors far apart, and groups of near copies of some of them: (centre, members, noise)."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(singles, dim))
    parts = [x]
    for members, noise in groups:
        c = rng.normal(size=dim)
        parts.append(c + rng.normal(size=(members, dim)) * noise)
    x = np.concatenate(parts)[rng.permutation(singles + sum(g[0] for g in groups))]
    return [(i, v.tolist()) for i, v in enumerate(x)]


def test_rotations_are_orthogonal_and_quantise_better():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 16)) * np.linspace(3, 0.3, 16)
    r = learn_rotation(x, np.random.default_rng(1))
    assert np.allclose(r @ r.T, np.eye(16))

    def loss(r):
        return ((np.where(x @ r > 0, 1, -1) - x @ r) ** 2).sum()

    # each round of the alternation lowers the quantisation loss
    losses = [loss(learn_rotation(x, np.random.default_rng(1), rounds=n)) for n in range(0, 31, 3)]
    assert all(b <= a * (1 + 1e-9) for a, b in zip(losses, losses[1:])) and losses[-1] < losses[0]
    share = (x @ r > 0).mean(axis=0)  # balanced bits
    assert ((share > 0.4) & (share < 0.6)).all()


def test_made_pairs_lie_at_the_cosine():
    u = qz._unit(np.random.default_rng(2).normal(size=(50, 12)))
    v = pairs_at(u, 0.95, np.random.default_rng(3))
    assert np.allclose((u * v).sum(axis=1), 0.95) and np.allclose((v * v).sum(axis=1), 1)


@pytest.mark.parametrize("scale", [1.0, np.r_[np.full(8, 3.0), np.full(24, 0.5)]])
def test_recall_of_the_tables(scale):
    rng = np.random.default_rng(5)
    x = qz._unit(rng.normal(size=(4000, 32)) * scale + 0.3)
    index = learn_index(x[:2000], 100_000, 0.95)
    fresh = x[2000:]
    for cosine, least in ((0.95, 0.99), (0.97, 0.995), (0.99, 0.999)):
        made = pairs_at(fresh, cosine, rng)
        a, b = index.code(fresh), index.code(made)
        met = (a == b).all(axis=2).any(axis=1) & ((a != b).sum(axis=(1, 2)) <= index.radius)
        assert met.mean() >= least
    assert index.bits >= 9
    # buckets are balanced: the fullest of a table holds a small part of all vectors
    keys = (index.code(x) * (1 << np.arange(index.bits))).sum(axis=2)
    assert max(np.unique(keys[:, t], return_counts=True)[1].max() for t in range(index.tables)) < len(x) / 20


@pytest.mark.parametrize("how", [{}, {"bucket": 4}, {"bucket": 8, "limit": 40, "block": 16}, {"limit": 30, "block": 16}])
def test_equals_brute_force(spark, how):
    rows = clusters(1, 500, [(60, 0.05), (40, 0.12), (25, 0.22), (2, 0.1), (3, 0.2)])
    rows += [(1000 + i, rows[0][1]) for i in range(50)]  # copies
    df = spark.createDataFrame(rows, SCHEMA)
    want, have = brute(rows), got(df, **how)
    assert [r[0] for r in want] == [r[0] for r in have]
    exact = sum(a == b for a, b in zip(want, have))
    links = sum(r[1] for r in want)
    assert all(h[1] <= w[1] for h, w in zip(have, want))  # no link below the threshold
    assert sum(h[1] for h in have) >= 0.99 * links and exact >= 0.97 * len(rows)


def test_pairs_inside_a_ball_are_not_compared(spark, monkeypatch):
    rows = clusters(3, 40, [(400, 0.02)])
    df = spark.createDataFrame(rows, SCHEMA)
    seen = []
    real = qz._hot_groups

    def spy(*a):
        work = real(*a)
        seen.append(work.groups.where("ball >= 0").count())
        return work

    monkeypatch.setattr(qz, "_hot_groups", spy)
    assert got(df, limit=60, block=50) == brute(rows)
    # all of the group lie in one ball; they are only compared with the few rows that fall beside them
    assert seen and seen[0] < 400 * 400 / 50


def test_edges(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]),
            (7, [float("nan"), 1.0]), (8, [float("-inf"), 1.0]), (9, [1.0]), (10, [3.0]), (11, [-1.0]), (None, [1.0, 2.1]),
            (12, [-0.0, 1.0]), (13, [0.0, 1.0]), (14, [1e30, 1e30]), (15, [1e-30, 1e-30]), (None, None), (None, [5.0, -1.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("h", "x", "rid", "n_links", "component_id", "kept", "ball", "t", "key"):
        df = df.withColumn(name, F.lit("x"))
    assert got(df) == brute(rows)
    assert near_vectors(df.limit(0)).count() == 0
    assert got(df.where("vec_id = 3")) == [(3, 0, 3, True)]
    wide = spark.createDataFrame([(1, [1e300, 1e300]), (2, [1e-300, 1e-300]), (3, [1e200, -1e200])],
                                 "vec_id long, embedding array<double>")
    assert got(wide) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
