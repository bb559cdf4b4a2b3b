import hashlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from kestrel.llm.exactdup import exact_groups, rice_decode, rice_encode

from .helpers import EDGE, documents


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").encode().lower()].append(i)
    out = []
    for i, t in rows:
        norm = (t or "").encode().lower()
        ids = [x for x in groups[norm] if x is not None]
        keep = max(ids, default=None)
        out.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm).hexdigest()))
    return out


def same(got, want):
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2 ** 60), min_size=1, max_size=200, unique=True), st.integers(1, 62))
def test_golomb_round_trip(values, rice):
    v = np.array(sorted(values), np.uint64) + np.uint64(2 ** 62)
    if (int(v[-1]) - 2 ** 62) >> rice > 1 << 16:
        rice = 50
    assert (rice_decode(rice_encode(v, 2 ** 62, rice), len(v), 2 ** 62, rice) == v).all()


def test_groups_with_a_hot_one(spark):
    rows = [(i, "Hot COPY") for i in range(400)] + [(1000 + i, f"text {i % 300} É") for i in range(450)]
    rows += [(5000, "text 7 é"), (5001, "TEXT 7 É")]
    df = documents(spark, rows).repartition(7)
    same(exact_groups(df).collect(), brute(rows))
    same(exact_groups(df, filter_bits=1 << 15, fingerprints_per_owner=50).collect(), brute(rows))


def test_edges(spark):
    same(exact_groups(documents(spark, EDGE, ["kept", "fp", "norm", "text_sha256"])).collect(), brute(EDGE))
    assert exact_groups(documents(spark, EDGE).limit(0)).count() == 0


def test_equal_digests_of_different_bytes(spark, monkeypatch):
    """With a digest of one byte many texts collide; bytes still tell them apart."""
    import kestrel.llm.exactdup as e

    class Short:
        def __init__(self, b):
            self.b = hashlib.md5(b).digest()[:1] * 32

        def digest(self):
            return self.b

    class Lib:
        sha256 = Short

    rows = [(i, f"t{i % 300}") for i in range(600)]
    monkeypatch.setattr(e, "hashlib", Lib)
    df = documents(spark, rows)
    base = df.select("doc_id", "text")
    digests, suspects = e._digests, e._suspects(bytes([255]) * 4096)
    batches = base.toArrow().to_batches()
    assert sum(b.num_rows for b in digests(iter(batches))) == sum(b.num_rows for b in suspects(iter(batches))) == 600
