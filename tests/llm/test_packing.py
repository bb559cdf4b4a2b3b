import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from kestrel.llm import packing
from kestrel.llm.packing import WordEncoder, _cut, best_fit, encoder, lower_bound, pack_documents, plain_word

from .helpers import EDGE, documents

VOCAB = public_tokenizers.path("word_bpe_49k.json")


def check(rows, docs, capacity):
    t = Tokenizer.from_file(VOCAB)
    want = []
    for doc, text in docs:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k, s in enumerate(range(0, len(ids), capacity)):
            want.append((doc, k, s, len(ids[s:s + capacity]), zlib.crc32(ids[s:s + capacity].tobytes())))
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted([tuple(r)[:5] for r in rows], key=key) == sorted(want, key=key)
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held), -(-sum(w[3] for w in want) // capacity)


def test_pieces_and_sequences(spark):
    docs = [(i, "Hello WORLD  café '<|endoftext|>' x y " * (i % 17)) for i in range(200)]
    rows = pack_documents(documents(spark, docs), capacity=64, pieces_per_part=50).collect()
    used, bound = check(rows, docs, 64)
    assert used <= bound * 1.05 + 1


def test_words_give_the_ids_of_the_text():
    t, enc = Tokenizer.from_file(VOCAB), encoder(VOCAB)
    texts = ["Don't STOP, now. it's!, x.", "<|ENDOFTEXT|> <|endoftext|>A, b.", "A\u0301, e\u0301. \u0130, \u03a3\u03a3.", "a,b c., d ,e",
             "word.\nNext,\tx\x1cy\u00a0z, 1, 2. \u4e2d\u6587, ok,", "", " ", "I'm, 's. 'LL. they'll,"]
    assert enc.ids([x.encode() for x in texts]) == [
        np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]


def test_capitals_that_compose_in_lower_case_only():
    t, enc = Tokenizer.from_file(VOCAB), encoder(VOCAB)
    texts = ["H\u0331", "T\u0308 T\u0308, xT\u0308y.", "J\u030c", "W\u030a", "H\u0331amza, MUH\u0331AMMAD. \u00c9T\u00c9, \u00e9A."]
    assert enc.ids([x.encode() for x in texts]) == [
        np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]


def test_plain_words_of_all_latin_letters():
    t, enc = Tokenizer.from_file(VOCAB), encoder(VOCAB)
    rng = np.random.default_rng(1)
    letters = [chr(c) for c in range(0x41, 0x180) if chr(c).isalpha()]
    words = letters + ["".join(rng.choice(letters, rng.integers(1, 9))) + rng.choice(["", ".", ",", "..", "'s", "!"])
                       for _ in range(4000)]
    assert sum(plain_word(w.encode()) is not None for w in words) > 2000
    assert plain_word("\u0130x".encode()) is plain_word(b"a1") is plain_word(b"") is plain_word(b".") is None
    assert plain_word("e\u0301".encode()) is plain_word("\u0394".encode()) is None
    assert enc.ids([w.encode() for w in words]) == [
        np.array(t.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]


def test_words_with_the_parting_sign():
    t, enc = Tokenizer.from_file(VOCAB), encoder(VOCAB)
    texts = ["\x01", "a \x01 b \x01\x01 c\x01d", "x<|endoftext|>\x01y <|startoftext|>", " ".join(f"w{i}Q." for i in range(3000)),
             "\u0301a \u0301 \u200d\u0301 x", "\ud55c\u1100 \u1161 \u11a8"]
    assert enc.ids([x.encode() for x in texts]) == [
        np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]


def test_words_go_with_their_task():
    """A worker keeps its encoder from task to task: neither a whole nor an ended task leaves words on it."""
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["alpha, beta 12\u00bd", "gamma " * 3000]})
    enc = encoder(VOCAB)
    first = [r for b in _cut(VOCAB, 4096, 1)(iter([batch])) for r in b.to_pylist()]
    assert [r["doc_id"] for r in first] == [1, 2] and not enc.memo and not enc.older
    task = _cut(VOCAB, 4096, 1)(iter([batch, batch]))
    assert next(task).to_pylist() == first and enc.memo
    task.close()
    assert not enc.memo and not enc.older
    again = [r for b in _cut(VOCAB, 4096, 1)(iter([batch])) for r in b.to_pylist()]
    assert again == first


def test_strings_encoded_in_turn(monkeypatch):
    """Few words a string and few strings at once give the same ids, and no call gets more strings."""
    words = [f"w{i}x" for i in range(100)]
    want = WordEncoder(VOCAB).ids([" ".join(words).encode()])
    monkeypatch.setattr(packing, "WORDS", 5)
    monkeypatch.setattr(packing, "RUNS", 2)
    enc, most = WordEncoder(VOCAB), []

    class Counted:
        def __init__(self, inner):
            self.inner, self.model = inner, inner.model

        def encode_batch_fast(self, texts, **kw):
            most.append(len(texts))
            return self.inner.encode_batch_fast(texts, **kw)

    enc.tokenizer = Counted(enc.tokenizer)
    assert enc.ids([" ".join(words).encode()]) == want
    assert max(most) == 2 and sum(most) == 20


def test_edges(spark):
    rows = pack_documents(documents(spark, EDGE, ["piece", "part", "bin"]), capacity=128).collect()
    check(rows, EDGE, 128)
    assert pack_documents(documents(spark, EDGE).limit(0)).count() == 0


def test_bound_never_exceeds_best_fit():
    rng = np.random.default_rng(5)
    for _ in range(60):
        sizes = np.sort(rng.integers(1, 101, rng.integers(1, 80)))[::-1]
        bins, offsets = best_fit(sizes.tolist(), 100)
        assert lower_bound(sizes, 100) <= max(bins) + 1
    assert lower_bound(np.array([51] * 7), 100) == 7
    assert lower_bound(np.array([34] * 9), 100) == 5
