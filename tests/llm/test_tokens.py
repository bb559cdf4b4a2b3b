import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kestrel.llm.tokens import count_tokens, encoder, segments_of

from .helpers import EDGE, documents

VOCAB = public_tokenizers.path("byte_bpe_50k.json")


def whole(texts):
    t = Tokenizer.from_file(VOCAB)
    return [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]


HARD = ["word " * 500, "x" * 3000, "a  b   c\n\n d " * 200, "中文" * 900, "1234567890" * 200,
        "don't we'll  <|endoftext|>  they've<|endoftext|>" * 60, " " * 2000, "\n" * 700 + "end", "a" + " " * 900 + "b " * 400,
        ("été    x " * 150), "!?" * 1200 + " tail", "\x1c a \x1d b" * 200]


def test_pieces_add_up():
    e = encoder(VOCAB)
    assert e.counts(HARD) == whole(HARD)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "Bc", " ", "  ", "\n", "'s", "12", "<|endoftext|>", "中", "\x1f", "-", "\t"]),
                max_size=40))
def test_pieces_add_up_on_any_text(parts):
    text = "".join(parts)
    assert encoder(VOCAB).counts([text]) == whole([text])
    assert "\n".join(" ".join(s) for s in segments_of(text)) == text


def test_splices_equal_whole_texts(spark):
    texts = HARD + [h + g for h, g in zip(HARD, HARD[1:])]
    df = documents(spark, list(enumerate(texts)))
    want = dict(enumerate(whole(texts)))
    for chunk, overlap in ((300, 300), (97, 13)):
        got = count_tokens(df, chunk_chars=chunk, overlap_chars=overlap).collect()
        assert {r.doc_id: r.n_tokens for r in got} == want and len(got) == len(texts)


def test_edges(spark):
    df = documents(spark, EDGE, ["n_tokens", "row", "chunk"])
    got = sorted((r.doc_id is None, r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in
                 count_tokens(df, chunk_chars=1000, overlap_chars=100).collect())
    n = whole([t for _, t in EDGE])
    want = sorted((i is None, i, len((t or "").encode()), k, k > 512) for (i, t), k in zip(EDGE, n))
    assert [g[1:] for g in got if not g[0]] == [w[1:] for w in want if not w[0]] and len(got) == len(want)
    assert count_tokens(df.limit(0)).count() == 0
