"""Exact deduplication by a Golomb-coded fingerprint exchange.

1. One scan hashes every normalised text (SHA-256; its first 8 bytes are the fingerprint).
2. Every partition sends each owner (an equal range of the fingerprint space) its sorted
   fingerprints, Golomb-Rice coded.
3. Owners decode, find the fingerprints that occur twice or more, and answer each
   partition with a bitmap over the list it sent.
4. A second scan passes on only suspects (texts whose fingerprint the bitmaps mark). They
   are shuffled and grouped by their bytes, with partial counts before the shuffle, so a
   group of copies of any size is a row per task.

The suspect filter of step 4 is a bit table of at most ``filter_bits`` bits (a fixed bound).
With more suspects than it can tell apart it lets other texts pass; these are verified
like suspects, so results do not depend on it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks_of, discard, slices, store, text_or_empty

OUTBOX_SCHEMA = "unit int, owner int, n int, rice int, code binary, twice binary"


def rice_encode(values: np.ndarray, base: int, rice: int) -> bytes:
    """Golomb-Rice code of ascending uint64 ``values`` as gaps, the first from ``base``."""
    gaps = np.diff(values, prepend=np.uint64(base))
    quotient = (gaps >> np.uint64(rice)).astype(np.int64)
    unary = np.zeros(int(quotient.sum()) + len(quotient), np.uint8)
    unary[np.cumsum(quotient + 1) - 1] = 1
    bits = np.unpackbits(gaps.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - rice:]
    head = np.packbits(unary).tobytes()
    return len(head).to_bytes(8, "little") + head + np.packbits(bits.ravel()).tobytes()


def rice_decode(code: bytes, n: int, base: int, rice: int) -> np.ndarray:
    """The values that ``rice_encode`` coded."""
    head = int.from_bytes(code[:8], "little")
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(code[8:8 + head], np.uint8)))[:n]
    quotient = np.diff(ones, prepend=-1) - 1
    low = np.unpackbits(np.frombuffer(code[8 + head:], np.uint8))[:n * rice].reshape(n, rice)
    wide = np.zeros((n, 64), np.uint8)
    wide[:, 64 - rice:] = low
    rest = np.packbits(wide, axis=1).view(">u8").ravel().astype(np.uint64)
    gaps = (quotient.astype(np.uint64) << np.uint64(rice)) | rest
    return np.cumsum(gaps, dtype=np.uint64) + np.uint64(base)


def _range(owner: int, owners: int) -> int:
    """First fingerprint of an owner's range."""
    return -(-(owner << 64) // owners)


def _digests(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        for part in slices(batch, 4096, 1, 8 << 20):
            own = [hashlib.sha256(t.lower()).digest() for t in part.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.frombuffer(b"".join(d[:8] for d in own), ">i8").astype(np.int64)),
                 pa.array([d.hex() for d in own])], ["doc_id", "fp", "text_sha256"])


def _send(owners: int):
    """Each task's sorted fingerprints, coded per owner; ``twice`` marks those it holds twice."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        unit = TaskContext.get().partitionId()
        held = [b.column(0).to_numpy(zero_copy_only=False) for b in batches]
        if not held:
            return
        values, counts = np.unique(np.concatenate(held).view(np.uint64), return_counts=True)
        edges = np.searchsorted(values, np.array([_range(o, owners) for o in range(1, owners)], np.uint64))
        for owner, (lo, hi) in enumerate(zip([0, *edges], [*edges, len(values)], strict=True)):
            if hi > lo:
                n = int(hi - lo)
                rice = max(1, min(63, ((1 << 64) // owners // n).bit_length() - 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([unit], pa.int32()), pa.array([owner], pa.int32()), pa.array([n], pa.int32()),
                     pa.array([rice], pa.int32()),
                     pa.array([rice_encode(values[lo:hi], _range(owner, owners), rice)], pa.binary()),
                     pa.array([np.packbits(counts[lo:hi] > 1).tobytes()], pa.binary())],
                    ["unit", "owner", "n", "rice", "code", "twice"])
    return run


def _answer(owners: int):
    """An owner's bitmaps: for each list sent to it, the fingerprints that occur elsewhere or twice."""
    def run(frame):
        import pandas as pd

        base = _range(int(frame["owner"].iloc[0]), owners)
        lists = [rice_decode(c, n, base, r) for c, n, r in zip(frame["code"], frame["n"], frame["rice"], strict=True)]
        local = [np.unpackbits(np.frombuffer(t, np.uint8))[:n] for t, n in zip(frame["twice"], frame["n"], strict=True)]
        _, where, count = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        marks = (count[where] > 1) | (np.concatenate(local) == 1)
        cuts = np.cumsum(frame["n"].to_numpy())[:-1]
        return pd.DataFrame({"unit": frame["unit"], "owner": frame["owner"],
                             "bitmap": [np.packbits(m).tobytes() for m in np.split(marks, cuts)]})
    return run


def _marked(owners: int):
    """Fingerprints of a unit's lists that their owners' bitmaps mark."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for owner, n, rice, code, bitmap in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                bits = np.unpackbits(np.frombuffer(bitmap, np.uint8))[:n].astype(bool)
                values = rice_decode(code, n, _range(owner, owners), rice)[bits]
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64))], ["fp"])
    return run


def _suspects(table: bytes):
    """Rows whose fingerprint's bit is set, with the normalised text."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bits, mask = np.frombuffer(table, np.uint8), len(table) * 8 - 1
        for batch in batches:
            for part in slices(batch, 4096, 1, 8 << 20):
                out: list[list] = [[], [], []]
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(),
                                     strict=True):
                    text = text.lower()
                    digest = hashlib.sha256(text).digest()
                    at = int.from_bytes(digest[:8], "big") & mask
                    if bits[at >> 3] >> (at & 7) & 1:
                        for o, v in zip(out, (doc, digest.hex(), text), strict=True):
                            o.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()),
                     pa.array(out[2], pa.binary()).cast(pa.string())], ["doc_id", "text_sha256", "norm"])
    return run


def duplicated_fingerprints(prints: DataFrame, fingerprints_per_owner: int = 1 << 20) -> DataFrame:
    """Fingerprints (column fp, long) that more than one row of ``prints`` has, once for each sender."""
    owners = blocks_of(prints.count(), fingerprints_per_owner)
    outbox = store(prints.select("fp").mapInArrow(_send(owners), OUTBOX_SCHEMA), "fp-outbox")
    answers = outbox.groupBy("owner").applyInPandas(_answer(owners), "unit int, owner int, bitmap binary")
    return (outbox.drop("twice").join(answers, ["unit", "owner"]).select("owner", "n", "rice", "code", "bitmap")
            .mapInArrow(_marked(owners), "fp long"))


def _bit_table(marked: DataFrame, filter_bits: int) -> bytes:
    """Bits of the marked fingerprints in a table of at most ``filter_bits`` bits (collected: its size is fixed)."""
    bits = 1 << 15
    while bits < filter_bits and bits < 16 * marked.count():
        bits *= 2
    at = F.col("fp").bitwiseAND(bits - 1)
    rows = (marked.select(F.shiftright(at, 15).alias("k"), at.bitwiseAND((1 << 15) - 1).alias("bit"))
            .groupBy("k").agg(F.bitmap_construct_agg("bit").alias("part")).collect())
    parts = {r["k"]: bytes(r["part"]) for r in rows}
    return b"".join(parts.get(k, bytes(1 << 12)) for k in range(bits >> 15))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 filter_bits: int = 1 << 26, fingerprints_per_owner: int = 1 << 20) -> DataFrame:
    """Groups of equal normalised texts: (doc_id, keep_id, group_size, kept, text_sha256) per row.

    Texts are equal when identical after lower-casing A-Z. The largest doc_id of a group
    stays. Null text: the empty one. Null ids never win over others; a group of null ids only
    has keep_id null and keeps them. Rows that repeat the kept id are that document and stay.
    An empty table gives an empty result. Extra columns are ignored.
    """
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), text_or_empty(docs, text_col).alias("text"))
    prints = store(base.mapInArrow(_digests, "doc_id long, fp long, text_sha256 string"), "fingerprints")
    marked = store(duplicated_fingerprints(prints, fingerprints_per_owner), "fp-marked")
    table = _bit_table(marked, filter_bits)
    discard(marked)
    # norm holds every byte of a suspect's text: grouping by it is the byte verification.
    suspects = base.mapInArrow(_suspects(table), "doc_id long, text_sha256 string, norm string")
    texts = suspects.groupBy("text_sha256", "norm").agg(F.max("doc_id").alias("keep_id"),
                                                        F.count("*").alias("group_size"))
    groups = store(texts.groupBy("text_sha256").agg(F.count("*").alias("texts"), F.max("keep_id").alias("keep_id"),
                                                    F.max("group_size").alias("group_size")), "copy-groups")
    whole = prints.drop("fp").join(groups.where("texts = 1").drop("texts"), "text_sha256", "left")
    whole = whole.select("doc_id", "text_sha256", F.when(F.col("group_size").isNull(), F.col("doc_id"))
                         .otherwise(F.col("keep_id")).alias("keep_id"),
                         F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"))
    clash = groups.where("texts > 1")
    if not clash.isEmpty():  # equal digests, different bytes: these rows are matched by their bytes
        by_bytes = (suspects.join(clash.select("text_sha256"), "text_sha256", "left_semi")
                    .join(texts, ["text_sha256", "norm"]).select(*whole.columns))
        whole = whole.join(clash.select("text_sha256"), "text_sha256", "left_anti").select(*whole.columns)
        whole = whole.unionByName(by_bytes)
    return whole.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                        "text_sha256")
