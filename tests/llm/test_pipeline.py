from collections import Counter, defaultdict

import corpus_pipeline as cp
from kestrel.llm import toxicity
from kestrel.llm.common import load, store

from .helpers import EDGE, documents
from .test_exactdup import brute as exact_brute
from .test_neardup import brute as near_brute

SMALL = "/root/testdata/sf0.001"


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_stages_equal_brute_force(spark):
    docs = load(spark, SMALL, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    model = toxicity.fit(docs, load(spark, SMALL, "labels"))
    want = {i for i, r in rows.items() if model.score(r.text or "") < 0.5}
    clean = store(cp.clean_stage(spark, docs, SMALL), "t")
    assert ids(clean) == Counter(want) and clean.columns == docs.columns
    want = {r[0] for r in exact_brute([(i, rows[i].text) for i in want]) if r[3]}
    exact = store(cp.exact_stage(spark, clean, SMALL), "t")
    assert ids(exact) == Counter(want) and exact.columns == docs.columns
    want = {r[0] for r in near_brute([(i, rows[i].text) for i in want], 5, 80) if r[3]}
    near = store(cp.near_stage(spark, exact, SMALL), "t")
    assert ids(near) == Counter(want) and near.columns == docs.columns
    mixed = store(cp.mix_stage(spark, near, SMALL), "t")
    assert mixed.columns == docs.columns and set(ids(mixed)) <= want and max(ids(mixed).values()) <= 3
    taken = {r.doc_id: r for r in cp.mix(near).collect()}
    assert ids(mixed) == Counter({i: int(r.taken / r.size + 0.5) for i, r in taken.items() if r.size and r.taken / r.size >= 0.5})
    packed = cp.pack_stage(spark, mixed, SMALL).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == ids(mixed)
    held = defaultdict(int)
    for r in packed:
        held[r.sequence_id] += r.length
    assert max(held.values()) <= 4096 and len(held) <= -(-sum(held.values()) // 4096) * 1.02 + 1


def test_stage_names_and_run(spark):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mix", "packing"]
    assert cp.run(spark, SMALL).count() > 0


def test_empty_documents(spark):
    docs = load(spark, SMALL, "documents").limit(0)
    for _, stage in cp.STAGES:
        docs = store(stage(spark, docs, SMALL), "t")
    assert docs.count() == 0


def test_stages_on_edge_rows(spark):
    # the model's ids stay those of the table; edge rows get ids beyond them, and one has no source
    far = [(i if i is None else i + 10**9, t) for i, t in EDGE]
    far += [(10**9 + 7, "\u00a0 one\ttwo "), (10**9 + 8, "  ", "en", None)]
    own = documents(spark, far)
    docs = load(spark, SMALL, "documents").select(*own.columns).unionByName(own)
    kept = {}
    for name, stage in cp.STAGES:
        docs = store(stage(spark, docs, SMALL), "t")
        kept[name] = [(r.doc_id, r.text if "text" in docs.columns else None) for r in docs.collect()
                      if r.doc_id is None or r.doc_id > 10**9]
    blank = lambda rows: Counter((i, t) for i, t in rows if not (t or "").split())
    pairs = Counter((r[0], r[1]) for r in far)
    assert Counter(kept["toxicity"]) <= pairs and blank(kept["toxicity"]) == blank(pairs.elements())
    # equal texts: the largest id (null text is the empty text); blank texts have no words to share
    want = {r[0] for r in exact_brute(kept["toxicity"]) if r[3]}
    assert {i for i, _ in kept["exact_dedup"]} == want
    assert blank(kept["near_dedup"]) == blank(kept["exact_dedup"])
    assert blank(kept["mix"]) == blank(kept["near_dedup"]) and sum(blank(kept["mix"]).values()) >= 3
    assert Counter(i for i, _ in kept["packing"])[10**9 + 2] == 1


def test_mix_of_wordless_documents_only(spark):
    docs = documents(spark, [(1, None), (2, ""), (3, " \n\t "), (None, None, "en", None)])
    assert ids(store(cp.mix_stage(spark, docs, SMALL), "t")) == ids(docs)


CLASHING = ["kept_id", "sha", "mix_id", "mix_source", "text_hash", "epochs", "mix_copy", "id", "own", "component", "k"]


def test_clashing_columns_pass_through(spark):
    docs = documents(spark, [(1, "one two three four five six"), (2, "ONE two three four five six"), (3, "other words here"),
                             (None, None)], CLASHING)
    for name, stage in cp.STAGES[1:4]:
        docs = store(stage(spark, docs, SMALL), "t")
        assert docs.columns[-len(CLASHING):] == CLASHING
        assert all(r[c] == "x" for r in docs.collect() for c in CLASHING), name
    assert set(ids(docs)) >= {None}


def near_kept(spark, rows):
    out = cp.near_stage(spark, documents(spark, rows), SMALL).collect()
    return Counter((r.doc_id, r.text) for r in out)


def test_near_copies_go_whatever_their_ids(spark):
    base = " ".join(f"w{i}" for i in range(60))
    copy, other = base + " more", " ".join(f"v{i}" for i in range(40))
    assert near_kept(spark, [(7, base), (9, copy), (9, other)]) == Counter([(7, base), (9, other)])
    assert near_kept(spark, [(None, other), (5, base), (None, copy)]) == Counter([(None, other), (5, base)])
    assert near_kept(spark, [(None, base), (None, copy)]).total() == 1
    assert near_kept(spark, [(3, base), (3, base), (4, copy)]) == Counter([(3, base), (3, base)])
    assert near_kept(spark, [(3, base), (3, copy)]).total() == 1


def test_exact_stage_with_one_id_and_two_texts(spark):
    rows = [(1, "same"), (2, "SAME"), (2, "else"), (None, "same"), (None, "lone")]
    out = cp.exact_stage(spark, documents(spark, rows), SMALL).collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter([(2, "SAME"), (2, "else"), (None, "lone")])
