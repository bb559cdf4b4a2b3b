"""Near-duplicate groups by b-bit MinHash.

1. Every document's word shingles are hashed to a set; documents with equal sets are one
   class and one representative goes on. Of each of 128 minima the lowest 2 bits are kept,
   packed to 32 bytes; bands of 4 whole minima give the buckets.
2. Inside a bucket of at most ``BUCKET`` representatives all packed signatures are compared
   by bit counts. With C the share of equal 2-bit values, the similarity corrected for
   chance collisions is (C - 1/4) / (1 - 1/4); pairs within 5 standard deviations of the
   threshold stay together. Larger buckets stay together whole. Only a spanning forest of
   each bucket leaves the task.
3. The components of these forests hold every candidate link. Their members' texts are
   fetched, and links are confirmed on full shingle sets inside blocks of at most
   ``BLOCK`` members, all pairs of a block at once by a product of membership matrices. A
   component larger than a block is split over many; ``HUBS`` common members in each block
   join what belongs together, and members that are still outside of the component's
   largest part are compared with all of its blocks. Only spanning forests leave a task.

Shingles are compared by 64-bit hashes. A pair at exactly the threshold shares no band with
a probability of 6e-11 (0.85) or 5e-8 (0.8); no cap drops a candidate.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, discard, slices, store, text_or_empty
from .exactdup import _bit_table

MINIMA, ROWS, LOW_BITS = 128, 4, 2
BANDS = MINIMA // ROWS
#: Representatives of a bucket that are compared in one task; members of a block; common members.
BUCKET, BLOCK, HUBS = 1024, 128, 16

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_PAIRS = np.uint64(0x5555555555555555)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer on uint64."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_FACTORS = (_odd(MINIMA, 7) & np.uint64(0xFFFFFFFF)).astype(np.uint32)[:, None]
_BAND = np.arange(BANDS, dtype=np.uint64)


def shingle_set(text: bytes, k: int) -> np.ndarray:
    """Sorted hashes of the distinct k-word shingles of a text (lower-cased A-Z).

    Words are runs of bytes other than ASCII white space. Fewer than k words: the whole
    sequence as one shingle; none: the empty set.
    """
    import xxhash

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    m = min(k, len(words))
    acc = np.full(len(words) - m + 1, m, np.uint64)
    for j, c in enumerate(_odd(m, 11)):
        acc += h[j:len(words) - m + 1 + j] * c
    return np.unique(_mix(acc))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The 128 minima (32 bits each) of a non-empty set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(low, (_FACTORS * x[at:at + 1024]).min(axis=1), out=low)
    return low


def packed_bits(minima: np.ndarray) -> bytes:
    """The lowest 2 bits of each minimum, packed."""
    v = (minima & np.uint32(3)).astype(np.uint8).reshape(-1, 4)
    return (v[:, 0] | v[:, 1] << 2 | v[:, 2] << 4 | v[:, 3] << 6).tobytes()


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One bucket key per band, the band's number mixed in."""
    rows = minima.reshape(BANDS, ROWS).astype(np.uint64)
    key = _mix(_BAND + np.uint64(1))
    for j in range(ROWS):
        key = _mix(key ^ rows[:, j])
    return key.view(np.int64)


def equal_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal 2-bit values of packed signatures (last axis: 4 words of 64 bits)."""
    x = a ^ b
    return MINIMA - np.bitwise_count((x | (x >> np.uint64(1))) & _PAIRS).sum(axis=-1, dtype=np.int64)


def least_equal(percent: int) -> int:
    """Equal values from which a pair stays: 5 standard deviations under the threshold."""
    t, chance = percent / 100, 2.0 ** -LOW_BITS
    c = t + (1 - t) * chance
    return math.floor(MINIMA * (c - 5 * math.sqrt(c * (1 - c) / MINIMA)))


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    n = len(linked)
    unseen, edges = np.ones(n, bool), []
    for root in range(n):
        if not unseen[root]:
            continue
        unseen[root] = False
        queue = [root]
        while queue:
            i = queue.pop()
            new = np.flatnonzero(linked[i] & unseen)
            unseen[new] = False
            edges.extend((i, int(j)) for j in new)
            queue.extend(new.tolist())
    return edges


def _sign(k: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, 1024, 2, 4 << 20):
                node, n, sig, bands = [], [], [], []
                for text in part.column(2).cast(pa.binary()).to_pylist():
                    s = shingle_set(text, k)
                    n.append(len(s))
                    if len(s):
                        low = signature(s)
                        node.append(hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest())
                        sig.append(packed_bits(low))
                        bands.append(band_keys(low))
                    else:
                        node.append(None)
                        sig.append(None)
                        bands.append(None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(node, pa.string()), pa.array(n, pa.int64()),
                     pa.array(sig, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    ["doc_id", "text_hash", "node", "n_shingles", "sig", "bands"])
    return run


def _runs(batches: Iterator, key_columns: int) -> Iterator:
    """Batches re-cut so that rows with equal leading columns never span two of them."""
    import pyarrow as pa

    rest = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        t = pa.Table.from_batches([batch])
        if rest is not None:
            t = pa.concat_tables([rest, t])
        keys = [t.column(c).to_numpy() for c in range(key_columns)]
        last = np.ones(t.num_rows, bool)
        for c in keys:
            last &= c == c[-1]
        cut = t.num_rows - int(last.sum())
        if cut:
            yield t.slice(0, cut)
        rest = t.slice(cut)
    if rest is not None:
        yield rest


def _starts(columns: list[np.ndarray]) -> np.ndarray:
    """First row of each run of equal keys."""
    change = np.ones(len(columns[0]), bool)
    change[1:] = False
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def _edges(a: list | np.ndarray, b: list | np.ndarray):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _compare_signatures(least: int):
    """Rows (bucket, rid, sig) sorted by bucket -> forests of the pairs that stay together."""
    def run(batches: Iterator) -> Iterator:
        for t in _runs(batches, 1):
            bucket, rid = t.column(0).to_numpy(), t.column(1).to_numpy()
            sig = np.frombuffer(b"".join(t.column(2).to_pylist()), np.uint64).reshape(-1, 4)
            start = _starts([bucket])
            size = np.diff(start, append=len(bucket))
            two = start[size == 2]
            ok = equal_values(sig[two], sig[two + 1]) >= least
            a, b = [rid[two[ok]]], [rid[two[ok] + 1]]
            for s, n in zip(start[size > 2], size[size > 2], strict=True):
                own = sig[s:s + n]
                linked = np.stack([equal_values(own, own[i]) >= least for i in range(n)])
                f = np.array(_forest(linked), np.int64).reshape(-1, 2) + s
                a.append(rid[f[:, 0]])
                b.append(rid[f[:, 1]])
            yield _edges(np.concatenate(a), np.concatenate(b))
    return run


def _passing(table: bytes):
    """Rows (doc_id, text_hash, text) whose hash's bit is set."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bits, mask = np.frombuffer(table, np.uint8), np.int64(len(table) * 8 - 1)
        for batch in batches:
            at = batch.column(1).to_numpy(zero_copy_only=False) & mask
            keep = bits[at >> 3] >> (at & 7).astype(np.uint8) & 1
            yield batch.filter(pa.array(keep.astype(bool)))
    return run


def _sets(k: int):
    """Rows (rid, comp, text) -> (rid, comp, shingles), the set as packed 64-bit hashes."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, 512, 2, 4 << 20):
                sets = [shingle_set(t, k).tobytes() for t in part.column(2).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sets, pa.binary())],
                                                 ["rid", "comp", "shingles"])
    return run


def common_counts(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all intersections between two lists of sets, by products of membership matrices.

    The union of the hashes is taken ``columns`` at a time, so memory is bounded.
    """
    sets = left + right
    values, where = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(where, kind="stable")
    where, row = where[order], row[order]
    shared = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, len(values), columns):
        s, e = np.searchsorted(where, [lo, lo + columns])
        m = np.zeros((len(sets), columns), np.float32)
        m[row[s:e], where[s:e] - lo] = 1
        shared += m[:len(left)] @ m[len(left):].T
    return shared.astype(np.int64)


def _confirm(percent: int, sided: bool):
    """Rows (comp, x, y, rid, side, shingles) sorted by (comp, x, y) -> forests of confirmed links.

    All pairs of a group; with ``sided``, pairs of side 0 with side 1.
    """
    def run(batches: Iterator) -> Iterator:
        for t in _runs(batches, 3):
            keys = [t.column(c).to_numpy() for c in range(3)]
            rid, side, blobs = t.column(3).to_numpy(), t.column(4).to_numpy(), t.column(5)
            a, b = [], []
            start = _starts(keys)
            for s, e in zip(start, [*start[1:], t.num_rows], strict=True):
                sets = [np.frombuffer(v, np.uint64) for v in blobs.slice(s, e - s).to_pylist()]
                one = np.flatnonzero(side[s:e] == 0) if sided else np.arange(e - s)
                two = np.flatnonzero(side[s:e] == 1) if sided else np.arange(e - s)
                size = np.array([len(v) for v in sets])
                if len(one) == 0 or len(two) == 0 or e - s < 2:
                    continue
                if e - s == 2:
                    shared = np.zeros((2, 2), np.int64)
                    shared[0, 1] = shared[1, 0] = len(np.intersect1d(*sets, assume_unique=True))
                    shared = shared[np.ix_(one, two)]
                else:
                    shared = common_counts([sets[i] for i in one], [sets[i] for i in two])
                union = size[one][:, None] + size[two][None, :] - shared
                linked = np.zeros((e - s, e - s), bool)
                linked[np.ix_(one, two)] = 100 * shared >= percent * union
                linked |= linked.T
                for i, j in _forest(linked):
                    a.append(int(rid[s + i]))
                    b.append(int(rid[s + j]))
            yield _edges(a, b)
    return run


def _grouped(rows: DataFrame, percent: int, sided: bool) -> DataFrame:
    return (rows.select("comp", "x", "y", "rid", "side", "shingles").repartition("comp", "x", "y")
            .sortWithinPartitions("comp", "x", "y").mapInArrow(_confirm(percent, sided), "a long, b long"))


def _candidate_components(reps: DataFrame, percent: int) -> DataFrame:
    """(rid, comp): components that hold every candidate pair; single representatives left out."""
    banded = reps.select("rid", F.explode("bands").alias("bucket"))
    many = banded.groupBy("bucket").agg(F.count("*").alias("n"), F.min("rid").alias("hub")).where("n > 1")
    members = store(banded.join(many, "bucket"), "buckets")
    star = members.where((F.col("n") > BUCKET) & (F.col("rid") != F.col("hub"))).select(
        F.col("rid").alias("a"), F.col("hub").alias("b"))
    close = (members.where(F.col("n") <= BUCKET).select("bucket", "rid").join(reps.select("rid", "sig"), "rid")
             .select("bucket", "rid", "sig").repartition("bucket").sortWithinPartitions("bucket")
             .mapInArrow(_compare_signatures(least_equal(percent)), "a long, b long"))
    found = components(star.unionByName(close)).select(F.col("node").alias("rid"), "comp")
    discard(members)
    return found


def _confirmed_components(sets: DataFrame, percent: int) -> DataFrame:
    """(node, comp) of the links confirmed on full sets inside the candidate components."""
    sizes = sets.groupBy("comp").agg(F.count("*").alias("members"))
    blocks = F.ceil(F.col("members") / BLOCK).cast("long")
    placed = store(sets.join(sizes, "comp").withColumn("blocks", blocks)
                   .withColumn("x", F.pmod(F.xxhash64("rid"), F.col("blocks")))
                   .withColumn("y", F.lit(0).cast("long")).withColumn("side", F.lit(0)), "set-blocks")
    split = placed.where("blocks > 1")
    own = placed.select("comp", "x", "y", "rid", "side", "shingles")
    if split.isEmpty():
        return components(_grouped(own, percent, False))
    # The members with the least hashes join every block of their component.
    order = F.row_number().over(Window.partitionBy("comp").orderBy("h", "rid"))
    low = (split.select("comp", "rid", "blocks", F.xxhash64("rid", F.lit(1)).alias("h"))
           .withColumn("slot", F.pmod(F.col("h"), F.col("blocks"))))
    near = low.withColumn("r", F.row_number().over(Window.partitionBy("comp", "slot").orderBy("h", "rid"))).where(
        F.col("r") <= HUBS)
    hubs = near.withColumn("r", order).where(F.col("r") <= HUBS).select("rid")
    spread = (split.join(hubs, "rid", "left_semi")
              .select("comp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("to"), "x", "y",
                      "rid", "side", "shingles").where("to <> x").drop("x").withColumnRenamed("to", "x"))
    first = store(_grouped(own.unionByName(spread.select(*own.columns)), percent, False), "links")
    joined = components(first)
    state = (split.join(joined.select(F.col("node").alias("rid"), F.col("comp").alias("part")), "rid", "left")
             .withColumn("part", F.coalesce("part", "rid")))
    state = store(state, "link-state")
    parts = state.groupBy("comp", "part").agg(F.count("*").alias("n"))
    main = parts.groupBy("comp").agg(F.max_by("part", F.struct("n", "part")).alias("main"))
    minor = state.join(main, "comp").where("part <> main")
    slots = minor.groupBy("comp").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("slots"))
    pieces = ["comp", "x", "y", "rid", "side", "shingles"]
    outer = (minor.join(slots, "comp").withColumn("y", F.pmod(F.xxhash64("rid", F.lit(2)), F.col("slots")))
             .withColumn("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
    inner = (state.join(slots, "comp").withColumn("side", F.lit(1))
             .withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1))))
    # A member meets itself across the sides; that edge joins nothing and is dropped.
    second = _grouped(outer.select(*pieces).unionByName(inner.select(*pieces)), percent, True).where("a <> b")
    found = components(first.unionByName(second))
    for old in (joined, state, first):
        discard(old)
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
                    percent: int = 80) -> DataFrame:
    """Near-duplicate components: (doc_id, n_shingles, component_id, kept), one row per input row.

    Documents are linked when 100 * intersection >= percent * union of their sets of distinct
    ``shingle_words``-word shingles (lower-cased A-Z; with fewer words the whole sequence is
    one shingle). ``component_id`` is the smallest doc_id reachable. Texts without words and
    null texts have no shingles and are linked with nothing. Null ids never are a component's
    smallest unless it has no other. Repeated rows are copies and share their component;
    ``kept`` holds for every row with the component's id. An empty table gives an empty
    result. Extra columns are ignored.
    """
    text = text_or_empty(docs, text_col)
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       text.alias("text"))
    signed = store(base.mapInArrow(_sign(shingle_words), "doc_id long, text_hash long, node string, n_shingles long, "
                                   "sig binary, bands array<long>"), "signatures")
    classes = signed.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.min("text_hash").alias("text_hash"),
        F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    reps = store(classes.withColumn("rid", F.monotonically_increasing_id()), "representatives")
    candidates = store(_candidate_components(reps, percent), "candidates")
    wanted = store(candidates.join(reps.select("rid", "text_hash"), "rid"), "wanted")
    table = _bit_table(wanted.select(F.col("text_hash").alias("fp")), 1 << 26)
    # One text per hash: copies meet before the shuffle, then the hash picks the member's text.
    texts = (base.mapInArrow(_passing(table), base.schema).groupBy("text_hash").agg(F.min("text").alias("text")))
    sets = (wanted.join(texts, "text_hash").select("rid", "comp", "text")
            .mapInArrow(_sets(shingle_words), "rid long, comp long, shingles binary"))
    linked = _confirmed_components(sets, percent)
    named = (reps.select("node", "doc_id", "rid").join(linked.withColumnRenamed("node", "rid"), "rid", "left")
             .withColumn("comp", F.coalesce("comp", "rid")))
    named = store(named, "named")
    least = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    ids = named.join(least, "comp").select("node", "component_id")
    out = signed.select("doc_id", "node", "n_shingles").join(ids, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))
