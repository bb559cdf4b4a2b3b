import random

import numpy as np
import pytest

import kestrel.llm.neardup as nd
from kestrel.llm.neardup import near_duplicates

from .helpers import EDGE, documents


def brute(rows, k, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w)} if 0 < len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)})
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(d, len(sets[i]), least.get(find(i)) if sets[i] else d,
             d == (least.get(find(i)) if sets[i] else d)) for i, (d, _) in enumerate(rows)]


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10 ** 6)}"
    return out


def corpus():
    """A group of chained edits, two of loose ones, shared passages, copies, clean texts."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    texts, chain = [], base
    for _ in range(40):
        chain = edited(rng, chain, rng.choice([1, 1, 2, 4]))
        texts.append(" ".join(chain))
    for _ in range(60):
        texts.append(" ".join(edited(rng, base, rng.choice([1, 2, 3, 5, 9]))))
    for _ in range(40):
        texts.append(" ".join(base[:50] + [f"u{rng.randrange(10 ** 6)}" for _ in range(60)]))
    texts += ["The same Copy"] * 30 + ["the SAME copy"] * 5
    for _ in range(80):
        texts.append(" ".join(f"c{rng.randrange(10 ** 5)}" for _ in range(rng.randrange(1, 90))))
    rng.shuffle(texts)
    return [(100 + i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize(("block", "bucket"), [(256, 1024), (16, 8)])
def test_components_equal_brute_force(spark, monkeypatch, block, bucket):
    monkeypatch.setattr(nd, "BLOCK", block)
    monkeypatch.setattr(nd, "BUCKET", bucket)
    monkeypatch.setattr(nd, "HUBS", 2)
    rows = corpus()
    got = near_duplicates(documents(spark, rows).repartition(5), shingle_words=3, percent=85).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, 3, 85))


def test_edges(spark):
    rows = [*EDGE, (9, "one two"), (10, "One  TWO"), (11, "one")]
    got = near_duplicates(documents(spark, rows, ["sig", "kept", "node", "comp"])).collect()
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, 5, 80), key=key)
    assert near_duplicates(documents(spark, rows).limit(0)).count() == 0


def test_estimate_is_near_the_similarity():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.85, 0.95):
        errors = []
        for _ in range(40):
            both = rng.integers(0, 2 ** 63, 400, dtype=np.uint64)
            n = int(400 * share)
            a = np.unique(both[:n + (400 - n) // 2])
            b = np.unique(np.concatenate([both[:n], both[n + (400 - n) // 2:]]))
            j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            sa, sb = (np.frombuffer(nd.packed_bits(nd.signature(x)), np.uint64) for x in (a, b))
            c = int(nd.equal_values(sa, sb)) / nd.MINIMA
            errors.append((c - 0.25) / 0.75 - j)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.07


def test_common_counts_in_narrow_blocks():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in (1, 5, 30, 50)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert nd.common_counts(sets, sets, columns=7).tolist() == want
