"""Toxicity by multiple-instance learning: document labels train a scorer of sentences.

A sentence's score is a logistic function of its words' features (the word, its prefixes
and suffixes); a document's score is the noisy-or of its sentences: the probability that at
least one is toxic. The likelihood of the document labels is maximised through the
noisy-or, so the model learns which sentences make a document toxic without a sentence
label, and ``locate_sentences`` names them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import crc_remainder, slices, text_or_empty

#: Labelled documents that the model learns from, features it keeps, words of a sentence (least and
#: most), words in a task's memo.
MAX_LABELLED, MAX_FEATURES, SHORT_WORDS, SENTENCE_WORDS, MEMO_WORDS = 6_000, 50_000, 8, 32, 100_000

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"\w+")


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    memo: dict[str, float] = field(default_factory=dict)

    def own(self) -> Model:
        """The same weights with a memo of its own: a worker keeps a broadcast model, so a task's
        memo must not grow on it."""
        return Model(self.weights, self.bias)

    def word_score(self, word: str) -> float:
        w = self.weights
        return sum(w.get(f, 0.0) for f in features(word.lower()))

    def sentence_scores(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, logit) of every sentence of a text; the empty text has one."""
        memo, out = self.memo, []
        if len(memo) > MEMO_WORDS:
            memo.clear()
        for start, end, words in sentences(text):
            total = self.bias
            for w in words:
                s = memo.get(w)
                if s is None:
                    s = memo[w] = self.word_score(w)
                total += s
            out.append((start, end, total))
        return out or [(0, 0, self.bias)]

    def score(self, text: str) -> float:
        """Noisy-or of the sentences' probabilities."""
        logits = [z for _, _, z in self.sentence_scores(text)]
        if len(logits) == 1:
            return float(1 / (1 + np.exp(-np.clip(logits[0], -50, 50))))
        return float(-np.expm1(-np.logaddexp(0, logits).sum()))


def features(word: str) -> list[str]:
    """The word, its prefixes of 3 to 6 and its suffixes of 3 to 5 characters."""
    n = len(word)
    return ["=" + word, *("<" + word[:k] for k in range(3, min(n, 7))),
            *(">" + word[-k:] for k in range(3, min(n, 6)))]


def sentences(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """(start, end, distinct words) of a text's sentences.

    Short ones are joined to the next until they have ``SHORT_WORDS`` words, long ones are read
    in parts of ``SENTENCE_WORDS`` words.
    """
    start, end, words = 0, 0, []
    for m in _SENTENCE.finditer(text):
        own = _WORD.findall(m[0])
        if not own:
            continue
        if len(own) > SENTENCE_WORDS:
            if words:
                yield start, end, list(dict.fromkeys(words))
                words = []
            spans = list(_WORD.finditer(m[0]))
            for k in range(0, len(spans), SENTENCE_WORDS):
                part = spans[k:k + SENTENCE_WORDS]
                yield m.start() + part[0].start(), m.start() + part[-1].end(), list(dict.fromkeys(w[0] for w in part))
            continue
        if not words:
            start = m.start()
        words += own
        end = m.end()
        if len(words) >= SHORT_WORDS:
            yield start, end, list(dict.fromkeys(words))
            words = []
    if words:
        yield start, end, list(dict.fromkeys(words))


def _select(docs: list[set[str]], gold: np.ndarray, max_features: int) -> list[str]:
    """Features whose log odds between toxic and other documents are at least 3 standard errors from 0."""
    pos, neg = Counter(), Counter()
    for words, y in zip(docs, gold, strict=True):
        (pos if y else neg).update({f for w in words for f in features(w)})
    n1, n0 = int(gold.sum()), int(len(gold) - gold.sum())
    strength = {}
    for f in pos.keys() | neg.keys():
        a, b = pos[f], neg[f]
        if a + b < 3:
            continue
        cells = (a + .5, n1 - a + .5, b + .5, n0 - b + .5)
        z = abs(np.log(cells[0] * cells[3] / (cells[1] * cells[2]))) / np.sqrt(sum(1 / c for c in cells))
        if z >= 3:
            strength[f] = z
    return sorted(strength, key=lambda f: (-strength[f], f))[:max_features]


def fit_rows(rows: list[tuple[str, int]], max_features: int = MAX_FEATURES, rounds: int = 120) -> Model:
    """Maximise the noisy-or likelihood of (text, label) rows by Adam."""
    pool: dict[str, str] = {}  # equal words share one string
    texts = [[(s, e, [pool.setdefault(w, w) for w in map(str.lower, ws)]) for s, e, ws in sentences(t)] or [(0, 0, [])]
             for t, _ in rows]
    gold = np.array([y for _, y in rows], float)
    chosen = _select([{w for _, _, ws in s for w in ws} for s in texts], gold, max_features)
    number = {f: i for i, f in enumerate(chosen)}
    known: dict[str, list[int]] = {}
    sent, feat, doc = [], [], []
    for d, parts in enumerate(texts):
        for _, _, words in parts:
            for w in words:
                if w not in known:
                    known[w] = [number[f] for f in features(w) if f in number]
                feat.extend(known[w])
                sent.extend([len(doc)] * len(known[w]))
            doc.append(d)
    sent, feat, doc = np.array(sent, np.int64), np.array(feat, np.int64), np.array(doc, np.int64)
    theta, bias, rate = np.zeros(len(chosen)), -5.0, 0.3
    m, v = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for r in range(1, rounds + 1):
        z = bias + np.bincount(sent, theta[feat], len(doc))
        none = np.bincount(doc, np.logaddexp(0, z), len(rows))  # -log of no toxic sentence
        odds = np.exp(-none) / np.maximum(-np.expm1(-none), 1e-12)
        share = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        g = share * np.where(gold == 1, odds, -1.0)[doc]
        grad = np.append(np.bincount(feat, g[sent], len(chosen)) / len(rows) - 2e-5 * theta, g.sum() / len(rows))
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        step = rate * (m / (1 - 0.9 ** r)) / (np.sqrt(v / (1 - 0.99 ** r)) + 1e-9)
        theta += step[:-1]
        bias += step[-1]
        rate *= 0.98
    return Model({f: float(w) for f, w in zip(chosen, theta, strict=True) if abs(w) > 1e-4}, float(bias))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_labelled: int = MAX_LABELLED) -> Model:
    """Learn from at most ``max_labelled`` labelled documents whose crc32(doc_id) mod 5 is not 0.

    The sample is the labels with the least hashes of their ids: a bounded table, so it is
    broadcast to the documents, and its texts come to the driver. Without labels of both
    kinds the model is a constant that rejects nothing.
    """
    gold = (labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("y"))
            .where("doc_id is not null and y is not null").where(crc_remainder(F.col("doc_id")) != 0))
    sample = (gold.groupBy("doc_id").agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), text_or_empty(docs, text_col).alias("text"))
    rows = (texts.join(F.broadcast(sample), "doc_id").select("doc_id", "text", "y")
            .limit(2 * max_labelled).collect())
    rows = sorted((r["doc_id"], r["text"], int(r["y"] > 0)) for r in rows)
    if len({y for _, _, y in rows}) < 2:
        return Model({}, -10.0)
    return fit_rows([(t, y) for _, t, y in rows])


def _scores(shared, name: str):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = shared.value.own()
        for batch in batches:
            for part in slices(batch, 1024, batch.num_columns - 1, 4 << 20):
                got = [min(1.0, max(0.0, model.score(t))) for t in part.column(batch.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(got, pa.float64())],
                                                 [*part.schema.names[:-1], name])
    return run


def _located(shared):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        model = shared.value.own()
        for batch in batches:
            for part in slices(batch, 1024, 1, 4 << 20):
                rows: list[list] = [[], [], [], [], []]
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    for k, (s, e, z) in enumerate(model.sentence_scores(text)):
                        if z >= 0 and e > s:
                            for r, x in zip(rows, (doc, k, s, text[s:e], 1 / (1 + np.exp(-min(z, 50)))), strict=True):
                                r.append(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.int64()),
                     pa.array(rows[3], pa.string()), pa.array(rows[4], pa.float64())],
                    ["doc_id", "sentence", "start", "sentence_text", "score"])
    return run


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score of every whole text: (doc_id, held_out, score, predicted), one row per input row.

    ``held_out``: crc32 of the id as text, mod 5, is 0. Null and empty texts get the score of a
    text without words. Null and repeated ids: a row each. An empty table gives an empty
    result. Extra columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_FEATURES weights
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), (crc_remainder(docs[id_col]) == 0).alias("held_out"),
                       text_or_empty(docs, text_col).alias("text"))
    got = base.mapInArrow(_scores(shared, "score"), "doc_id long, held_out boolean, score double")
    return got.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose whole text scores below ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = "_score_" + "_".join(docs.columns)
    whole = docs.select("*", text_or_empty(docs, text_col).alias("_text_" + name))
    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    scored = whole.mapInArrow(_scores(shared, name), schema)
    return scored.where(scored[name] < threshold).select(*(scored[c] for c in docs.columns))


def locate_sentences(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sentences more likely toxic than not: (doc_id, sentence, start, sentence_text, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), text_or_empty(docs, text_col).alias("text"))
    return base.mapInArrow(_located(shared), "doc_id long, sentence int, start long, sentence_text string, score double")
