"""Hard negatives by Four-Russians scoring: subset-sum tables indexed with packed bit planes.

Vectors of whole numbers are stored as bit planes in two's complement: for each group of eight
dimensions and each plane one byte, whose bits are the plane's bits of the eight components. Of
an anchor, a table for each group holds the sums of all 256 subsets of its eight components. The
inner product is then, plane by plane, the sum of one table entry a group, shifted by the plane
(the sign plane is subtracted): exact, with lookups and additions only. Tables of many anchors
lie side by side, so one lookup serves all of them.

Anchors and candidates meet in blocks. A first pass finds each anchor's positives among the rows
of its label; a second one the best rows of other labels between the bounds of each positive.
Only the best few of each block leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks_of, store

#: Candidates and anchors of a block; anchors and candidates scored at a time.
BLOCK, ANCHOR_BLOCK, ANCHORS, CANDIDATES = 4096, 4096, 64, 1024


def planes_needed(v: np.ndarray) -> np.ndarray:
    """Bits of the two's complement of the widest component of each row."""
    x = np.where(v < 0, ~v, v).max(axis=1, initial=0)
    need = np.ones(len(v), np.int64)
    for b in range(63):
        wider = x >> b > 0
        if not wider.any():
            break
        need += wider
    return need


def pack_planes(v: np.ndarray, planes: int) -> np.ndarray:
    """Rows x planes x groups bytes of whole numbers; the last group is filled up with zeros."""
    v = np.pad(v, ((0, 0), (0, -v.shape[1] % 8)))
    bits = (v[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def unpack_planes(packed: np.ndarray, dim: int) -> np.ndarray:
    """The whole numbers that ``pack_planes`` packed."""
    bits = np.unpackbits(packed, axis=2, bitorder="little")[:, :, :dim].astype(np.int64)
    out = np.zeros((len(packed), dim), np.int64)
    for b in range(packed.shape[1]):
        out += bits[:, b] << b if b < packed.shape[1] - 1 else -(bits[:, b] << b)
    return out


def subset_sums(anchors: np.ndarray, dtype) -> np.ndarray:
    """Groups x 256 x anchors: the sum of each subset of eight components, built by doubling."""
    a = np.pad(anchors, ((0, 0), (0, -anchors.shape[1] % 8))).astype(dtype)
    groups = a.shape[1] // 8
    table = np.zeros((groups, 256, len(a)), dtype)
    for g in range(groups):
        for j in range(8):
            table[g, 1 << j:2 << j] = table[g, :1 << j] + a[:, 8 * g + j]
    return table


def scores(anchors: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Inner products, anchors x candidates, by table lookups. They have to fit into 64 bits."""
    largest = int(np.abs(anchors).max(initial=0)) * max(1, anchors.shape[1])
    narrow = np.int32 if largest < 1 << 31 else np.int64
    out = np.empty((len(anchors), len(packed)), np.int64)
    planes = packed.shape[1]
    for at in range(0, len(anchors), ANCHORS):
        table = subset_sums(anchors[at:at + ANCHORS], narrow)
        for lo in range(0, len(packed), CANDIDATES):
            part = packed[lo:lo + CANDIDATES]
            total = np.zeros((len(part), table.shape[2]), np.int64)
            row = np.empty((len(part), table.shape[2]), narrow)
            for b in range(planes):
                plane = np.zeros((len(part), table.shape[2]), narrow)
                for g in range(len(table)):
                    np.take(table[g], part[:, b, g], axis=0, out=row, mode="clip")
                    plane += row
                wide = plane.astype(np.int64) << b
                total += wide if b < planes - 1 else -wide
            out[at:at + ANCHORS, lo:lo + CANDIDATES] = total.T
    return out


def _pack(batches: Iterator) -> Iterator:
    """(vec_id, label, v) -> (vec_id, label, dim, planes, packed)."""
    import pyarrow as pa

    for batch in batches:
        n = batch.num_rows
        lists = batch.column(2)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        values = lists.values.to_numpy(zero_copy_only=False)
        dims = np.diff(offsets)
        planes, blobs = np.ones(n, np.int64), [b""] * n
        for d in np.unique(dims):
            rows = np.flatnonzero(dims == d)
            v = values[offsets[rows][:, None] + np.arange(d)[None, :]].astype(np.int64)
            planes[rows] = planes_needed(v)
            for p in np.unique(planes[rows]):
                same = planes[rows] == p
                for i, packed in zip(rows[same], pack_planes(v[same], int(p)), strict=True):
                    blobs[i] = packed.tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(planes, pa.int32()),
             pa.array(blobs, pa.binary())], ["vec_id", "label", "dim", "planes", "packed"])


def _read(table, dim: int) -> np.ndarray:
    """Packed rows of one length, brought to the widest row's planes by repeating the sign plane."""
    groups, planes, blobs = -(-dim // 8), table.column("planes").to_numpy(), table.column("packed").to_pylist()
    width = int(planes.max(initial=1))
    out = np.zeros((len(blobs), width, groups), np.uint8)
    for p in np.unique(planes):
        rows = np.flatnonzero(planes == p)
        own = np.frombuffer(b"".join(blobs[i] for i in rows), np.uint8).reshape(len(rows), p, groups)
        out[rows, :p] = own
        out[rows, p:] = own[:, -1:]
    return out


def _best(s: np.ndarray, ids: np.ndarray, ok: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k best allowed scores of each row, ties to the smaller id."""
    row, col = np.nonzero(ok)
    if not len(row):
        return row, col
    s_ok = s[row, col]
    if s.shape[1] > k:
        low = np.iinfo(np.int64).min
        kth = np.partition(np.where(ok, s, low), s.shape[1] - k, axis=1)[:, s.shape[1] - k]
        keep = s_ok >= kth[row]
        row, col, s_ok = row[keep], col[keep], s_ok[keep]
    order = np.lexsort((ids[col], -s_ok, row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], col[place < k]


def _parts(left, right):
    dim = left.column("dim")[0].as_py()
    return (unpack_planes(_read(left, dim), dim), left.column("vec_id").to_numpy(), left.column("label").to_numpy(),
            _read(right, dim), right.column("vec_id").to_numpy(), right.column("label").to_numpy())


def _positives(k: int):
    """A block of anchors and one of candidates -> the k best rows of each anchor's label."""
    def run(left, right):
        import pyarrow as pa

        out = [np.zeros((0, 3), np.int64)]
        if left.num_rows and right.num_rows:
            anchors, own, label, packed, ids, labels = _parts(left, right)
            key = left.column("anchor").to_numpy()
            for value in np.unique(label):
                a, c = np.flatnonzero(label == value), np.flatnonzero(labels == value)
                for at in range(0, len(a) if len(c) else 0, 512):
                    some = a[at:at + 512]
                    s = scores(anchors[some], packed[c])
                    row, col = _best(s, ids[c], own[some][:, None] != ids[c][None, :], k)
                    out.append(np.stack([key[some][row], ids[c][col], s[row, col]], axis=1))
        found = np.concatenate(out)
        return pa.table({n: found[:, i] for i, n in enumerate(("anchor", "positive_id", "positive_score"))})
    return run


def _negatives(k: int, percent: int):
    """A block of anchors with their positives' scores and one of candidates -> each positive's k best negatives."""
    def run(left, right):
        import pyarrow as pa

        out = [np.zeros((0, 4), np.int64)]
        if left.num_rows and right.num_rows:
            anchors, own, label, packed, ids, labels = _parts(left, right)
            order = np.argsort(ids, kind="stable")
            packed, ids, labels = packed[order], ids[order], labels[order]
            key, wanted = left.column("anchor").to_numpy(), left.column("positives").to_pylist()
            for at in range(0, len(anchors), 512):
                s = scores(anchors[at:at + 512], packed)
                for i, line in enumerate(s, at):
                    # 100 n >= percent p in whole numbers: n >= ceil(percent p / 100)
                    bounds = [(p["place"], -(-percent * p["positive_score"] // 100), p["positive_score"]) for p in wanted[i]]
                    least, most = min(b[1] for b in bounds), max(b[2] for b in bounds)
                    c = np.flatnonzero((line >= least) & (line <= most) & (labels != label[i]) & (ids != own[i]))
                    c = c[np.argsort(-line[c], kind="stable")]
                    falling = -line[c]
                    for place, low, high in bounds:
                        first = np.searchsorted(falling, -high)
                        some = c[first:min(first + k, np.searchsorted(falling, -low, side="right"))]
                        out.append(np.stack([np.full(len(some), key[i]), np.full(len(some), place), ids[some],
                                             line[some]], axis=1))
        found = np.concatenate(out)
        return pa.table({n: found[:, i] for i, n in enumerate(("anchor", "place", "negative_id", "negative_score"))})
    return run


def hard_negatives(table: DataFrame, positives: int = 5, negatives: int = 5, percent: int = 80, every: int = 100,
                   factor: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   block: int = BLOCK, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """The hardest negatives of each anchor and positive.

    Returns (anchor_id, positive_id, rank, negative_id, positive_score, negative_score). Components
    become floor(factor * x); a score is the integer inner product with the anchor; higher scores
    come first, ties by the smaller id. Anchors are the rows whose id is divisible by ``every``, an
    anchor's positives its first ``positives`` rows of the same label and another id, its negatives
    for one positive the first ``negatives`` rows of other labels and another id with
    percent * positive <= 100 * negative <= 100 * positive. Fewer: all of them.

    Rows with a null id, label or vector, or a null, NaN or infinite component take no part.
    Vectors of different lengths are never compared. Equal anchor rows are one anchor, rows of one
    id that differ are anchors each; repeated candidates count each. An empty table gives an empty
    result. Extra columns are ignored. Scores have to fit into 64 bits.
    """
    v = F.transform(table[vector_col], lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = (table.select(table[id_col].cast("long").alias("vec_id"), table[label_col].cast("long").alias("label"),
                         v.alias("v"))
            .where("vec_id is not null and label is not null and v is not null").where(~bad)
            .select("vec_id", "label", F.transform("v", lambda x: F.floor(x * factor).cast("long")).alias("v")))
    packed = store(rows.mapInArrow(_pack, "vec_id long, label long, dim int, planes int, packed binary"), "packed-vectors")
    anchors = store(packed.where(F.col("vec_id") % every == 0).distinct()
                    .withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    nb, na = blocks_of(packed.count(), block), blocks_of(anchors.count(), anchor_block)

    def ladder(n: int):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    keys = ["ab", "db", "dim"]
    data = packed.withColumn("db", F.pmod(F.xxhash64("vec_id"), F.lit(nb))).withColumn("ab", ladder(na))

    def met(asked: DataFrame, fn, schema: str) -> DataFrame:
        asked = asked.withColumn("ab", F.pmod(F.xxhash64("anchor"), F.lit(na))).withColumn("db", ladder(nb))
        return asked.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInArrow(fn, schema)

    found = met(anchors, _positives(positives), "anchor long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    best = store(found.withColumn("place", F.row_number().over(order).cast("long")).where(F.col("place") <= positives),
                 "positives")
    asked = anchors.join(best.groupBy("anchor").agg(F.collect_list(F.struct("place", "positive_score"))
                                                    .alias("positives")), "anchor")
    hard = met(asked, _negatives(negatives, percent), "anchor long, place long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    hard = hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return (hard.join(best, ["anchor", "place"]).join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
