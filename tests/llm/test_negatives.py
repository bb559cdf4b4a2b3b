import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.negatives import hard_negatives, pack_planes, planes_needed, scores, subset_sums, unpack_planes

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType())])


def brute(rows, positives=5, negatives=5, percent=80, every=100):
    good = []
    for i, v, label in rows:
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, tuple(math.floor(256 * float(np.float32(x))) for x in v), label))
    out = []
    for i, v, label in {r for r in good if r[0] % every == 0}:
        met = [(-sum(a * b for a, b in zip(v, w)), j, m) for j, w, m in good if j != i and len(w) == len(v)]
        best = sorted((s, j) for s, j, m in met if m == label)[:positives]
        for ps, p in best:
            hard = sorted((s, j) for s, j, m in met if m != label and percent * -ps <= 100 * -s <= 100 * -ps)
            out += [(i, p, r + 1, j, -ps, -s) for r, (s, j) in enumerate(hard[:negatives])]
    return sorted(out)


def got(df, **kw):
    return sorted(map(tuple, hard_negatives(df, **kw).collect()))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 20), st.integers(1, 5), st.integers(1, 5), st.integers(1, 40), st.integers(0, 2 ** 32 - 1))
def test_scores_are_inner_products(dim, m, n, width, seed):
    rng = np.random.default_rng(seed)
    top = 1 << min(width, 28)
    a, c = rng.integers(-top, top, (m, dim)), rng.integers(-top, top, (n, dim))
    p = int(planes_needed(c).max(initial=1))
    packed = pack_planes(c, p)
    assert (unpack_planes(packed, dim) == c).all()
    assert (scores(a, packed) == a @ c.T).all()


def test_planes_hold_the_ends_of_their_range():
    v = np.array([[0], [-1], [1], [-2], [127], [-128], [128], [2 ** 62], [-2 ** 63]])
    assert planes_needed(v).tolist() == [1, 1, 2, 2, 8, 8, 9, 64, 64]
    for row, p in zip(v, planes_needed(v)):
        assert unpack_planes(pack_planes(row[None, :], int(p)), 1)[0, 0] == row[0]


def test_table_entries_are_subset_sums():
    a = np.arange(1, 17).reshape(1, 16) ** 2
    table = subset_sums(a, np.int64)
    for byte in (0, 1, 37, 128, 255):
        for g in range(2):
            assert table[g, byte, 0] == sum(int(a[0, 8 * g + j]) for j in range(8) if byte >> j & 1)


@pytest.mark.parametrize("blocks", [{}, {"block": 90, "anchor_block": 2}])
def test_equals_brute_force(spark, blocks):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(4, 10))
    rows = [(i, (centres[i % 4] + rng.normal(size=10) * 0.4).tolist(), int(rng.integers(0, 4))) for i in range(800)]
    rows += [(i, [0.25] * 10, i % 2) for i in range(800, 1200)]  # one hot vector under two labels
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert want and got(df, **blocks) == want


def test_edges(spark):
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (0, [2.0, 1.0], 2), (1, None, 1), (2, [1.0, None], 1),
            (3, [float("nan"), 1.0], 1), (4, [float("inf"), 1.0], 1), (5, [1.0], 1), (None, [1.0, 1.0], 1), (6, [], 1),
            (100, [], 1), (9, [], 2), (7, [1.0, 1.9], 2), (7, [1.0, 1.9], 2), (8, [1.0, 2.0], 1), (10, [1.0, 2.0], None),
            (11, [0.001, 1000.0], 1), (12, [2.0, 1.5], 2), (200, [-1.0, -2.0], 3), (13, [1.0, 1.0], 3), (-100, [3.0, 3.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("v", "anchor", "place", "rank", "ab", "db", "dim", "packed"):
        df = df.withColumn(name, F.lit("x"))
    assert got(df) == brute(rows)
    assert hard_negatives(df.limit(0)).count() == 0
    one = spark.createDataFrame([(100, [1.0, 0.5], 1)], SCHEMA)
    assert hard_negatives(one).count() == 0
