"""Best-fit packing of token sequences with certified bin counts.

Documents are tokenized once; rows (document, piece, start, length, checksum) go on. Pieces
are dealt to partitions of bounded size by hash, and each partition packs its own by
best-fit decreasing. Dual feasible functions give a lower bound on any packing of the same
pieces: a partition whose bin count equals its bound is certified. Partitions with a gap,
and the emptiest sequence of every partition, exchange their pieces: those go to new
partitions together and best-fit decreasing runs again, as long as an exchange has more
than one partition to join.
"""

from __future__ import annotations

import functools
import os
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks_of, discard, slices, store, text_or_empty

#: About the memory that a task's memo of word ids takes before it starts anew, and the text read at once.
MEMO_BYTES, ENTRY_BYTES, SLICE_BYTES = 32 << 20, 160, 1 << 20

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED_SCHEMA = (PIECE_SCHEMA + ", part long, bin int, offset long, fill long, "
                 "part_bins int, part_bound int")


#: Words that are encoded in one string, strings encoded at once, and the sign that parts words there.
WORDS, RUNS, PART = 1024, 16, b"\x01"


def byte_characters() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: shown ones for themselves, the
    others the next ones from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(0x100 + hidden.index(b)) for b in range(256)}


_BYTES = byte_characters()


def plain_word(word: bytes) -> tuple[bytes, bytes] | None:
    """(lower-cased stem, sign) of a word of Latin letters and at most one full stop or comma behind them.

    The vocabulary composes (NFC), lower-cases, and takes a run of letters as one pre-token and a
    sign after it as another. Letters below U+0180 are composed already and lower-case one by one, but
    for the dotted capital I. None for any other word: the tokenizer reads it as a whole.
    """
    sign = word[-1:] if word[-1:] in (b",", b".") else b""
    stem = word[:-1] if sign else word
    if stem.isalpha():  # ASCII letters only
        return stem.lower(), sign
    text = stem.decode()
    if text.isalpha() and max(text) < "\u0180" and "\u0130" not in text:
        return text.lower().encode(), sign
    return None


class WordEncoder:
    """Token ids of a text as little-endian unsigned 32-bit bytes, by a memo of words.

    The vocabulary's pre-tokenizer forgets white space, and its normalizer changes nothing across
    it, so a text's ids are those of its words one after the other. New plain words go to the
    vocabulary's model as pre-tokens; the others are encoded many in one string, parted by a sign of
    its own token id. A full memo becomes the older one and gives its words to the new one as
    they recur.
    """

    def __init__(self, vocab: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise RuntimeError("ids are packed as the machine's own 32-bit integers, which must be little-endian")
        self.tokenizer = Tokenizer.from_file(vocab)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.part = self.tokenizer.encode(PART.decode(), add_special_tokens=False).ids
        self.forget()
        self.signs = dict(zip((b",", b"."), self._one_by_one([b",", b"."]), strict=True))

    def _one_by_one(self, words: list[bytes]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in coded]

    def encode(self, words: list[bytes]) -> None:
        """Put the ids of new words into the memo."""
        tokenize, memo, rest = self.tokenizer.model.tokenize, self.memo, []
        for w in words:
            plain = plain_word(w)
            if plain is None:
                rest.append(w)
                continue
            stem, sign = plain
            ids = memo.get(stem)
            if ids is None:
                text = stem.decode() if stem.isascii() else stem.decode("latin-1").translate(_BYTES)
                ids = memo[stem] = array("I", [t.id for t in tokenize(text)]).tobytes()
            memo[w] = ids + self.signs[sign] if sign else ids
        words = rest
        # A word that may hold a special string or the parting sign stands alone.
        alone = [w for w in words if b"<|" in w or PART in w]
        if alone or len(self.part) != 1:
            alone = alone if len(self.part) == 1 else words
            self.memo.update(zip(alone, self._one_by_one(alone), strict=True))
            lone = set(alone)
            words = [w for w in words if w not in lone]
        runs = [words[i:i + WORDS] for i in range(0, len(words), WORDS)]
        between = f" {PART.decode()} "
        # an encoding takes many times its text, so only a few are held at once
        coded = (e for at in range(0, len(runs), RUNS) for e in self.tokenizer.encode_batch_fast(
            [between.join([w.decode() for w in r]) for r in runs[at:at + RUNS]], add_special_tokens=False))
        for run, e in zip(runs, coded, strict=True):
            ids = np.array(e.ids, np.uint32)
            ends = 4 * np.flatnonzero(ids == self.part[0])
            raw = ids.tobytes()
            if len(ends) != len(run) - 1:
                self.memo.update(zip(run, self._one_by_one(run), strict=True))
                continue
            ends = [*ends.tolist(), len(raw)]
            starts = [0, *(x + 4 for x in ends)]
            self.memo.update(zip(run, map(raw.__getitem__, map(slice, starts, ends)), strict=True))

    def forget(self) -> None:
        """Drop the memo: a worker keeps the encoder, so a task's words must not stay on it."""
        self.room, self.memo, self.older = MEMO_BYTES, {}, {}

    def ids(self, texts: list[bytes]) -> list[bytes]:
        if self.room < 0:
            self.memo, self.older, self.room = {}, self.memo, MEMO_BYTES
        cut = [t.split() for t in texts]
        memo, words = self.memo, set()
        for c in cut:
            words.update(c)
        fresh = words.difference(memo)
        known = fresh.intersection(self.older)
        for w in known:
            memo[w] = self.older[w]
        before = len(memo)
        new = list(fresh - known)
        self.encode(new)
        self.room -= sum(map(len, new)) + ENTRY_BYTES * (len(known) + len(memo) - before)
        get = memo.__getitem__
        return [b"".join(map(get, c)) for c in cut]


@functools.lru_cache(maxsize=2)
def encoder(vocab: str) -> WordEncoder:
    return WordEncoder(vocab)


def default_vocab() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _cut(vocab: str, capacity: int, end_id: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        enc, end, step = encoder(vocab), np.array([end_id], "<u4").tobytes(), 4 * capacity
        try:
            for batch in batches:
                for part in slices(batch, 512, 1, SLICE_BYTES):
                    rows: list[list] = [[], [], [], [], []]
                    texts = part.column(1).cast(pa.binary()).to_pylist()
                    for doc, ids in zip(part.column(0).to_pylist(), enc.ids(texts), strict=True):
                        ids += end
                        for k, at in enumerate(range(0, len(ids), step)):
                            own = ids[at:at + step]
                            for r, v in zip(rows, (doc, k, at // 4, len(own) // 4, zlib.crc32(own)), strict=True):
                                r.append(v)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()),
                         *(pa.array(r, pa.int64()) for r in rows[2:])],
                        ["doc_id", "piece", "start", "length", "ids_crc32"])
        finally:
            enc.forget()
    return run


def token_pieces(docs: DataFrame, vocab: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Tokenize whole texts, end each with ``end_id``, cut those above ``capacity`` tokens."""
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), text_or_empty(docs, text_col).alias("text"))
    return base.mapInArrow(_cut(vocab or default_vocab(), capacity, end_id), PIECE_SCHEMA)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Best of two families of dual feasible functions: no packing has fewer bins.

    The threshold family counts lengths above capacity - t as whole bins and forgets those
    below t; the rounding family takes (k + 1) * length / capacity down to whole parts of k
    unless it is whole. Integer arithmetic throughout.
    """
    if not len(lengths):
        return 0
    n = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((n * x).sum()) // capacity)
    count, mass = np.cumsum(n), np.cumsum(n * x)
    for t in range(1, capacity // 2 + 1):
        whole = int(count[capacity] - count[capacity - t])
        middle = int(mass[capacity - t] - mass[t - 1])
        best = max(best, whole - (-middle // capacity))
    for k in range(1, 33):
        scaled = (k + 1) * x
        u = np.where(scaled % capacity == 0, x * k, scaled // capacity * capacity)
        best = max(best, -(-int((n * u).sum()) // (k * capacity)))
    return best


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length, taken in the order given (decreasing for a good fit).

    Open bins are kept by room left; the bit mask's lowest bit at or above the length is the
    best fit.
    """
    mask, open_bins, room, bins, offsets = 0, {}, [], [], []
    for size in lengths:
        fits = mask >> size
        if fits:
            r = size + (fits & -fits).bit_length() - 1
            b = open_bins[r].pop()
            if not open_bins[r]:
                mask ^= 1 << r
        else:
            r, b = capacity, len(room)
            room.append(capacity)
        bins.append(b)
        offsets.append(capacity - r)
        room[b] = r - size
        if room[b]:
            open_bins.setdefault(room[b], []).append(b)
            mask |= 1 << room[b]
    return bins, offsets


def _pack(capacity: int):
    def run(frame):
        frame = frame.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True])
        sizes = frame["length"].to_numpy()
        bins, offsets = best_fit(sizes.tolist(), capacity)
        frame = frame.assign(bin=np.array(bins, "int32"), offset=offsets)
        frame["fill"] = frame.groupby("bin")["length"].transform("sum")
        frame["part_bins"] = np.int32(max(bins) + 1)
        frame["part_bound"] = np.int32(lower_bound(sizes, capacity))
        return frame
    return run


def _packed(pieces: DataFrame, capacity: int) -> DataFrame:
    return store(pieces.groupBy("part").applyInPandas(_pack(capacity), PACKED_SCHEMA), "packed")


def pack_pieces(pieces: DataFrame, capacity: int = 4096, pieces_per_part: int = 16_384) -> DataFrame:
    """Put pieces (``PIECE_SCHEMA``) into sequences; adds sequence_id, offset and the certificate.

    ``part_bins`` and ``part_bound`` are the bin count and the lower bound of the partition
    that packed the piece last. Partitions hold about ``pieces_per_part`` pieces at any input
    size, those of an exchange too.
    """
    columns = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]
    pieces = store(pieces, "pieces")
    parts = blocks_of(pieces.count(), pieces_per_part)
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64(*columns), F.lit(parts)))
    current, done, level = _packed(dealt, capacity), None, 0
    discard(pieces)
    while parts > 1:
        # A certified partition gives up its emptiest sequence, one with a gap its emptier half.
        bins = (current.groupBy("part", "bin").agg(F.first("fill").alias("fill"),
                                                   F.first("part_bins").alias("part_bins"),
                                                   F.first("part_bound").alias("part_bound")))
        by_fill = F.percent_rank().over(_by("part", "fill", "bin"))
        rank = F.row_number().over(_by("part", "fill", "bin"))
        given = (bins.where(F.col("fill") < capacity)
                 .select("part", "bin", (F.when(F.col("part_bins") > F.col("part_bound"),
                                                (by_fill < 0.5) | (rank == 1))
                                         .otherwise(rank == 1)).alias("given")).where("given"))
        marked = current.join(given, ["part", "bin"], "left")
        stay = marked.where("given is null").drop("given").withColumn("level", F.lit(level))
        done = stay if done is None else done.unionByName(stay)
        moved = store(marked.where("given").select(*columns, "part"), "exchanged")
        n_moved = moved.count()
        if not n_moved:
            break
        fewer = min(blocks_of(n_moved, pieces_per_part), parts - 1)
        joined = F.floor(F.col("part") * fewer / parts).cast("long")
        current, level, parts = _packed(moved.withColumn("part", joined), capacity), level + 1, fewer
        discard(moved)
    else:
        last = current.withColumn("level", F.lit(level))
        done = last if done is None else done.unionByName(last)
    sequence = (F.col("level") * F.lit(1 << 56) + F.col("part") * F.lit(1 << 24) + F.col("bin")).cast("long")
    return done.select(*columns, sequence.alias("sequence_id"), "offset", "part_bins", "part_bound")


def _by(key: str, *order: str):
    from pyspark.sql import Window

    return Window.partitionBy(key).orderBy(*order)


def pack_documents(docs: DataFrame, vocab: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = 4096, end_id: int = 1, pieces_per_part: int = 16_384) -> DataFrame:
    """Pack all documents to sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, part_bins,
    part_bound. Only documents longer than a sequence are cut. Null text: as the empty one (its
    end id alone). Null and repeated ids: packed row by row, ties in any order. An empty table
    gives an empty result. Extra columns are ignored.
    """
    return pack_pieces(token_pieces(docs, vocab, id_col, text_col, capacity, end_id), capacity, pieces_per_part)
