import math

import numpy as np
from pyspark.sql import types as T

import kestrel.llm.topk as tk
from kestrel.llm.topk import CoverTree, dual_search, top_k

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()),
                       T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("rank", T.StringType())])


def brute(rows, k, every):
    good = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for i, v in {(i, tuple(v)) for i, v in good if i % every == 0}:
        found = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in good if j != i and len(w) == len(v))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out)


def test_equals_brute_force_over_many_blocks(spark):
    rng = np.random.default_rng(0)
    rows = [(i, (rng.normal(size=8) + 2 * (i % 3)).tolist()) for i in range(700)]
    rows += [(700 + i, [0.5] * 8) for i in range(300)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = sorted(map(tuple, top_k(df, 5, 50, block=150, query_block=6).collect()))
    assert got == brute(rows, 5, 50)


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]),
            (5, [1.0]), (None, [1.0, 1.0]), (6, []), (50, []), (7, [-1.0, 0.001]), (8, [-1.0, 0.001]), (100, [3.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    assert sorted(map(tuple, top_k(df, 5, 50).collect())) == brute(rows, 5, 50)
    assert top_k(df.limit(0)).count() == 0


def test_tree_covers_and_pruned_search_is_exact():
    rng = np.random.default_rng(3)
    x = np.floor(256 * np.concatenate([rng.normal(c, 0.05, (400, 6)) for c in (-3, 0, 1, 4)] + [np.ones((300, 6))]))
    tree = CoverTree(x)
    for centre, radius, _, rows in tree.nodes:
        if rows is not None and len(rows):
            assert np.sqrt(((x[rows] - x[centre]) ** 2).sum(axis=1)).max() <= radius + 1e-9
    rows = np.concatenate([r for *_, r in tree.nodes if r is not None])
    assert sorted(rows.tolist()) == list(range(len(x)))
    ids = np.arange(len(x))
    scores, found = dual_search(x[::37], ids[::37], x, ids, 5)
    full = x[::37] @ x.T
    for q, i in enumerate(ids[::37]):
        order = [j for j in np.lexsort((ids, -full[q])) if j != i][:5]
        assert found[q].tolist() == order and scores[q].tolist() == full[q][order].tolist()


def test_very_large_components(spark):
    rows = [(0, [5e6, 5e6]), (1, [5e6, 5e6 - 1]), (2, [5e6, 5e6 - 2])]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    assert sorted(map(tuple, top_k(df, 2, 50).collect())) == brute(rows, 2, 50)
    assert tk.BLOCK > 0
