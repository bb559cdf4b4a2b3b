"""Token counts of whole texts by overlap resynchronisation.

Short texts are encoded whole. A huge text is cut into overlapping chunks that Spark
spreads over the cluster; each chunk is encoded on its own, with offsets, and neighbours
are spliced at a boundary that both encodings share and that is proven stable:

* the pre-tokenizer scans left to right and looks at no character before its position, so
  two scans that both start a pre-token at p agree from p on;
* the left chunk's pre-tokens before p are final once a character other than white space
  follows p, at least one special string's length before the chunk's end: no match that
  ends at p has then looked at the cut.

A joint without such a boundary (a run of letters longer than the overlap) fails; texts
with a failed joint are encoded again with chunks and overlap twice as long, until every
joint is proven or a chunk holds the whole text.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, store, text_or_empty

#: About the memory that a worker's memo of piece counts takes before it starts anew.
MEMO_BYTES = 120 << 20
#: No special string of the vocabulary is longer; a splice stays so far from a cut.
SPECIAL_LENGTH = 64

_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def segments_of(text: str) -> list[list[str]]:
    """Cut a text to segments (joined by newlines) of pieces (joined by spaces).

    The pre-tokenizer always starts a pre-token at a lone space between two characters that
    are no white space (it joins the space to the letters, digits or signs that follow), and
    makes a pre-token of a lone newline between two such characters. So the encodings of the
    pieces, those after a segment's first with their space, and of the newlines add up to
    the text's. A text with any other white space is one segment, cut at lone spaces only.
    """
    segments = []
    for line in text.split("\n"):
        words = line.split()
        if not words or " ".join(words) != line:
            return [_LONE_SPACE.split(text)]
        segments.append(words)
    return segments


class Encoder:
    """The vocabulary's tokenizer with a bounded memo of piece counts."""

    def __init__(self, vocab: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocab)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.newline = len(self.tokenizer.encode("\n", add_special_tokens=False))
        self.room = MEMO_BYTES
        self.first: dict[str, int] = {}
        self.later: dict[str, int] = {}

    def _learn(self, memo: dict[str, int], pieces: set[str], lead: str) -> None:
        """Count the pieces that ``memo`` lacks."""
        fresh = list(pieces.difference(memo))
        if fresh:
            self.room -= sum(map(len, fresh)) + 64 * len(fresh)
            for p, e in zip(fresh, self.tokenizer.encode_batch_fast(
                    [lead + p for p in fresh], add_special_tokens=False), strict=True):
                memo[p] = len(e)

    def learn(self, cut: list[list[list[str]]]) -> None:
        """Make ``first`` know every segment's first piece and ``later`` the others."""
        if self.room < 0:
            self.first.clear()
            self.later.clear()
            self.room = MEMO_BYTES
        firsts, laters = set(), set()
        for segments in cut:
            for s in segments:
                firsts.add(s[0])
                laters.update(s[1:])
        self._learn(self.first, firsts, "")
        self._learn(self.later, laters, " ")

    def counts(self, texts: list[str]) -> list[int]:
        """Number of tokens of each text."""
        cut = [segments_of(t) for t in texts]
        self.learn(cut)
        first, later = self.first, self.later.__getitem__
        return [sum([first[s[0]] + sum(map(later, s[1:])) for s in segments], self.newline * (len(segments) - 1))
                for segments in cut]

    def starts(self, text: str, lo: int, hi: int) -> tuple[list[int], list[int]]:
        """Pre-token starts of ``text`` in [lo, hi), and the number of tokens before each."""
        cut = segments_of(text)
        self.learn([cut])
        where, before = [], []
        at, done = 0, 0
        for k, segment in enumerate(cut):
            if k:
                if lo <= at < hi:
                    where.append(at)
                    before.append(done)
                at += 1
                done += self.newline
            for j, p in enumerate(segment):
                shown = " " + p if j else p
                if at + len(shown) > lo and at < hi:
                    e = self.tokenizer.encode(shown, add_special_tokens=False)
                    last = None
                    for i, (word, (s, _)) in enumerate(zip(e.word_ids, e.offsets, strict=True)):
                        if word != last and lo <= at + s < hi:
                            where.append(at + s)
                            before.append(done + i)
                        last = word
                at += len(shown)
                done += self.later[p] if j else self.first[p]
        return where, before


@functools.lru_cache(maxsize=2)
def encoder(vocab: str) -> Encoder:
    return Encoder(vocab)


def default_vocab() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _count_whole(vocab: str):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc = encoder(vocab)
        for batch in batches:
            for part in slices(batch, 256, 2, 4 << 20):
                n = enc.counts(part.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"])
    return run


def _cut(chunk: int, overlap: int):
    """Rows (row, doc_id, n_bytes, text_hash, chunk, last, body): the overlapping chunks of a text."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = ["row", "doc_id", "n_bytes", "text_hash", "chunk", "last", "body"]
        for batch in batches:
            for i in range(batch.num_rows):
                row, doc, size, h, text = (batch.column(c)[i].as_py() for c in range(5))
                n = max(1, -(-(len(text) - overlap) // chunk))
                for lo in range(0, n, 64):
                    ks = range(lo, min(n, lo + 64))
                    body = [text[k * chunk:] if k == n - 1 else text[k * chunk:(k + 1) * chunk + overlap]
                            for k in ks]
                    m = len(body)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row] * m, pa.int64()), pa.array([doc] * m, pa.int64()),
                         pa.array([size] * m, pa.int64()), pa.array([h] * m, pa.int64()),
                         pa.array(list(ks), pa.int64()), pa.array([k == n - 1 for k in ks]),
                         pa.array(body, pa.string())], names)
    return run


def _encode_chunks(vocab: str, chunk: int, overlap: int):
    """Per chunk: tokens, and the pre-token starts (absolute, with tokens before) of both zones."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc = encoder(vocab)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for k, last, body in zip(*(batch.column(c).to_pylist() for c in (4, 5, 6)), strict=True):
                base = k * chunk
                left = enc.starts(body, 0, overlap) if k else ([], [])
                right: tuple[list[int], list[int]] = ([], [])
                if not last:
                    safe = len(body[:len(body) - SPECIAL_LENGTH].rstrip())
                    right = enc.starts(body, chunk, min(safe, len(body)))
                for o, v in zip(out, (enc.counts([body])[0], [base + p for p in left[0]],
                                      left[1], [base + p for p in right[0]], right[1]), strict=True):
                    o.append(v)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in range(6)), pa.array(out[0], pa.int64()),
                 *(pa.array(o, longs) for o in out[1:])],
                ["row", "doc_id", "n_bytes", "text_hash", "chunk", "last", "n", "left_at", "left_n",
                 "right_at", "right_n"])
    return run


def _spliced(docs: DataFrame, vocab: str, chunk: int, overlap: int) -> DataFrame:
    """Counts of huge texts; see the module's docstring."""
    done = None
    while True:
        chunks = docs.mapInArrow(_cut(chunk, overlap), "row long, doc_id long, n_bytes long, "
                                 "text_hash long, chunk long, last boolean, body string")
        coded = store(chunks.repartition("row", "chunk").mapInArrow(
            _encode_chunks(vocab, chunk, overlap),
            "row long, doc_id long, n_bytes long, text_hash long, chunk long, last boolean, n long, "
            "left_at array<long>, left_n array<long>, right_at array<long>, right_n array<long>"),
            "token-chunks")
        nxt = coded.select("row", (F.col("chunk") - 1).alias("chunk"), "left_at", "left_n")
        joint = (coded.where("not last").select("row", "text_hash", "chunk", "right_at", "right_n")
                 .join(nxt, ["row", "chunk"])
                 .withColumn("p", F.array_min(F.array_intersect("right_at", "left_at"))))
        joint = store(joint.select(
            "row", "text_hash", F.col("p").isNull().alias("failed"),
            F.expr("right_n[array_position(right_at, p) - 1]").alias("before"),
            F.expr("left_n[array_position(left_at, p) - 1]").alias("again")), "token-joints")
        total = (coded.select("row", "doc_id", "n_bytes", "text_hash", "last", F.when(F.col("last"), F.col("n"))
                              .otherwise(0).alias("t"))
                 .unionByName(joint.where("not failed").select(
                     "row", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_bytes"),
                     "text_hash", F.lit(False).alias("last"), (F.col("before") - F.col("again")).alias("t")))
                 .groupBy("row", "text_hash").agg(
                     F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"),
                     F.sum("t").alias("n_tokens"), F.count_if("last").alias("rows")))
        failed = joint.where("failed").select("text_hash").distinct()
        if failed.isEmpty():
            part = total.select("doc_id", "n_bytes", "n_tokens")
            return part if done is None else done.unionByName(part)
        part = total.join(failed, "text_hash", "left_anti").select("doc_id", "n_bytes", "n_tokens")
        done = part if done is None else done.unionByName(part)
        docs = docs.join(failed, "text_hash", "left_semi").select("row", "doc_id", "n_bytes", "text_hash", "text")
        chunk, overlap = 2 * chunk, 2 * overlap


def count_tokens(docs: DataFrame, vocab: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", limit: int = 512, chunk_chars: int = 65_536,
                 overlap_chars: int = 1_024) -> DataFrame:
    """Tokens of every whole text: (doc_id, n_bytes, n_tokens, over_limit), one row per input row.

    ``vocab`` is a byte-level BPE file of the tokenizers library. Texts of more than
    ``chunk_chars`` characters are counted in overlapping chunks, spliced as the module says.
    Null text: as the empty one (0 bytes, 0 tokens). Null and repeated ids: a row each. An
    empty table gives an empty result. Extra columns are ignored.
    """
    if overlap_chars > chunk_chars:
        raise ValueError("the overlap must not exceed the chunk")
    vocab = vocab or default_vocab()
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), text_or_empty(docs, text_col).alias("text"))
    base = base.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    long = F.length("text") > chunk_chars + overlap_chars
    whole = base.where(~long).mapInArrow(_count_whole(vocab), "doc_id long, n_bytes long, n_tokens long")
    huge = base.where(long).select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_bytes",
                                   F.xxhash64("text").alias("text_hash"), "text")
    counted = whole.unionByName(_spliced(huge, vocab, chunk_chars, overlap_chars))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
