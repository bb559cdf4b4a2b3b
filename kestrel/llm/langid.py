"""Language identification by a linear-chain conditional random field over words.

Every word gets hashed features: character n-grams of 2 to 4 with word boundaries (those at
a boundary are its affixes) and the word itself (lexicon). Transitions are learned from
sequences that switch language: spans of labelled documents put one after another.
Forward-backward labels every word of a whole text; the document's language is the one
with the highest mean posterior.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_remainder, slices, text_or_empty
from .crf import Model, feature_sums, mean_posteriors, train

#: Documents per language, words per document and documents that the model learns from, at most; the
#: last one is shared out evenly when there are more than 32 languages. Characters of a span for each word.
DOCS_PER_LANG, WORDS_PER_DOC, MAX_DOCS, SPAN = 600, 60, 19_200, 24
FEATURES = 1 << 18
_PRIMES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


@functools.cache
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def feature_orders(texts: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """([(feature numbers, features per word) of each kind], words per text), vectorised.

    Texts are lower-cased and read whole; a word is a run of letters. Kinds: n-grams of 2, 3
    and 4 characters, a word's borders counting as characters, and the word itself.
    """
    lower = [t.lower() for t in texts]
    codes = np.frombuffer(" ".join([*lower, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    alpha = _letters()[codes]
    keep = alpha.copy()
    keep[1:] |= alpha[:-1]  # letters, and one border after each word
    of_text = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lower])
    c = np.concatenate([[np.uint64(1)], np.where(alpha, codes, 1)[keep].astype(np.uint64)])
    edge = c == 1
    borders = np.flatnonzero(edge)
    n_words = len(borders) - 1
    per_text = np.bincount(of_text[keep][borders[1:] - 1], minlength=len(texts)).astype(np.int64)
    if not n_words:
        return [], per_text
    word = np.cumsum(edge) - 1  # a border belongs to the word that follows it
    kinds, h = [], c * _PRIMES[0]
    inside = np.ones(len(c), bool)
    for n in (2, 3, 4):
        h = (h[:-1] ^ c[n - 1:]) * _PRIMES[n - 1]
        inside = inside[:len(h)]
        if n > 2:
            inside = inside & ~edge[n - 2:n - 2 + len(h)]
        kinds.append(((h >> np.uint64(46))[inside].astype(np.int64),
                      np.bincount(word[:len(h)][inside], minlength=n_words)[:n_words]))
    place = (np.arange(len(c)) - borders[word]).astype(np.uint64)
    whole = np.add.reduceat(c * _PRIMES[0] * (place * _PRIMES[2] | np.uint64(1)), borders[:-1]) * _PRIMES[3]
    kinds.append(((whole >> np.uint64(46)).astype(np.int64), np.ones(n_words, np.int64)))
    return kinds, per_text


def word_scores(weights: np.ndarray, kinds: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Emission scores of the words (words x languages)."""
    if not kinds:
        return np.zeros((0, weights.shape[1]), np.float32)
    return sum(feature_sums(weights, f, n) for f, n in kinds)


def word_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, features per word) of one text, all kinds of a word together."""
    kinds, _ = feature_orders([text])
    if not kinds:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.concatenate([np.repeat(np.arange(len(n)), n) for _, n in kinds])
    order = np.argsort(owner, kind="stable")
    return np.concatenate([f for f, _ in kinds])[order], sum(n for _, n in kinds)


def _sample(docs: DataFrame, docs_per_lang: int, words_per_doc: int) -> list[tuple[str, str, bool]]:
    """(lang, span, whether it was cut out) of a hash sample of learnable documents of every language.

    About ``docs_per_lang`` documents of each, fewer where that makes more than ``MAX_DOCS``; of a long
    text a span of ``SPAN`` characters a word from a hashed place comes to the driver.
    """
    known = docs.where("lang is not null").where(crc_remainder(F.col("doc_id")) != 0)
    counts = known.groupBy("lang").count().orderBy("lang").collect()  # one row a language
    if not counts:
        return []
    each = max(1, min(docs_per_lang, MAX_DOCS // len(counts)))
    spread = 1 << 20
    limits = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(-(-each * spread // r["count"])))])
    at = F.pmod(F.xxhash64("doc_id", F.lit("language sample")), F.lit(spread))
    width = SPAN * words_per_doc
    over = F.length("text") - width
    start = F.when(over > 0, F.pmod(F.xxhash64("doc_id", F.lit("span")), F.greatest(over, F.lit(1)))).otherwise(F.lit(0))
    rows = (known.where(at < F.coalesce(limits[F.col("lang")], F.lit(0)))
            .select("lang", F.substring("text", (start + 1).cast("int"), F.lit(width)).alias("span"), (over > 0).alias("cut"))
            .limit(2 * each * len(counts)).collect())
    return sorted((r["lang"], r["span"], r["cut"]) for r in rows)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        docs_per_lang: int = DOCS_PER_LANG, words_per_doc: int = WORDS_PER_DOC, seed: int = 5) -> Model | None:
    """Learn from documents whose crc32(doc_id) mod 5 is not 0 and whose language is known.

    The sample is bounded: about ``docs_per_lang`` documents of each language, ``MAX_DOCS`` of all, a
    random span of ``words_per_doc`` words of each. None when there is nothing to learn from.
    """
    named = docs.select(docs[id_col].alias("doc_id"), text_or_empty(docs, text_col).alias("text"),
                        docs[lang_col].cast("string").alias("lang"))
    rows = _sample(named, docs_per_lang, words_per_doc)
    labels = sorted({lang for lang, _, _ in rows})
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    feats, gold, owner = [], [], []
    for i, (lang, text, cut) in enumerate(rows):
        f, n = word_features(text)
        edge = int(cut and len(n) > 2)  # the words at a cut may be parts of words
        if not len(n):
            continue
        lo = edge + int(rng.integers(0, max(1, len(n) - 2 * edge - words_per_doc + 1)))
        ends = np.concatenate([[0], np.cumsum(n)])
        hi = min(len(n) - edge, lo + words_per_doc)
        feats.append((f[ends[lo]:ends[hi]], n[lo:hi]))
        gold.append(labels.index(lang))
        owner.append(i)
    if not feats:
        return None
    # Sequences that switch: half of a span, then half of another document's, and so on.
    pieces = [(f, n, g) for (f, n), g in zip(feats, gold, strict=True)]
    halves = []
    for f, n, g in pieces:
        cut = int(rng.integers(0, len(n) + 1))
        at = int(n[:cut].sum())
        halves += [(f[:at], n[:cut], g), (f[at:], n[cut:], g)]
    halves = [h for h in halves if len(h[1])]
    rng.shuffle(pieces)
    mixed = [halves[i] for i in rng.permutation(len(halves))]
    sequences = [[p] for p in pieces] + [mixed[i:i + 3] for i in range(0, len(mixed), 3)]
    flat = [p for s in sequences for p in s]
    lengths = np.array([sum(len(p[1]) for p in s) for s in sequences])
    return train(np.concatenate([p[0] for p in flat]), np.concatenate([p[1] for p in flat]),
                 np.concatenate([np.full(len(p[1]), p[2]) for p in flat]), lengths, labels, FEATURES)


def word_posteriors(text: str, model: Model) -> np.ndarray:
    """Posterior of each language for each word of one text (words x languages)."""
    from .crf import forward_backward

    kinds, _ = feature_orders([text])
    if not kinds:
        return np.zeros((0, len(model.labels)))
    e = word_scores(model.weights, kinds)[None].astype(float)
    return forward_backward(e, np.ones(e.shape[:2], bool), model.transitions, model.start)[0][0]


def _predict(shared):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model: Model = shared.value
        for batch in batches:
            for part in slices(batch, 2048, 2, 1 << 20):
                kinds, words = feature_orders(part.column(2).to_pylist())
                mean = mean_posteriors(word_scores(model.weights, kinds), words, model)
                best = mean.argmax(axis=1)
                lang = [model.labels[b] if w else "und" for b, w in zip(best, words, strict=True)]
                score = np.clip(mean[np.arange(len(best)), best], 0, 1) * (words > 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(lang), pa.array(score.astype(float))],
                    ["doc_id", "held_out", "lang_pred", "score"])
    return run


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       model: Model | None = None) -> DataFrame:
    """Language of every whole text: (doc_id, held_out, lang_pred, score), one row per input row.

    ``held_out``: crc32 of the id as text, mod 5, is 0; such rows are never learned from. Without
    a letter (or null): ``und`` with score 0; so is every text if no label can be learned.
    Null and repeated ids: a row each (a null id counts as the empty text). An empty table
    gives an empty result. Extra columns are ignored.
    """
    model = model or fit(docs, id_col, text_col, lang_col)
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), (crc_remainder(docs[id_col]) == 0).alias("held_out"),
                       text_or_empty(docs, text_col).alias("text"))
    if model is None:
        return base.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size: FEATURES x languages
    return base.mapInArrow(_predict(shared), "doc_id long, held_out boolean, lang_pred string, score double")
