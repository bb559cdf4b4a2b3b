"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

1. Equal vectors are one class; a representative goes on. On a bounded sample of
   representatives rotations are learned (iterative quantisation): centre, project on the
   principal directions, then alternate between the signs of the rotated sample and the
   rotation that brings it nearest to them (orthogonal Procrustes). Each rotation gives as
   many code bits as it has directions; more bits come from rotations learned from other
   random starts.
2. The code is cut to tables of equal numbers of bits, so many that a bucket of N vectors
   holds ``BUCKET`` on average. Pairs at exactly the wanted cosine are made from the sample,
   and tables are added until ``RECALL`` of them meet in a bucket; pairs above it meet more
   often. The Hamming radius is 6 standard deviations above the mean of these pairs.
3. All representatives are put into the tables. In a bucket whole codes are compared by bit
   counts; rows without a partner in the radius go no further, the others form small groups.
4. Only these fetch their original vectors, and all pairs of a group are reranked by their
   cosine in double precision. A link counts in the first table in which its ends meet, so no
   pair leaves a task: only sums of links and spanning forests do.

A bucket of more than ``LIMIT`` rows is a hot group. Vectors within half of the wanted angle of
its centroid are linked with each other for certain (angles obey the triangle inequality):
they are one ball, counted without comparison. The rest is compared in blocks, among itself
and with the balls. A hot bucket of widely different vectors costs its members squared.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, discard, store
from .neardup import _forest, _runs, _starts

#: Rows of the sample (fewer if they would exceed SAMPLE_BYTES); directions and rounds of a rotation.
SAMPLE_ROWS, SAMPLE_BYTES, DIRECTIONS, ROUNDS = 4096, 32 << 20, 256, 30
#: Average rows of a bucket; share of made pairs that has to be found; most rotations tried for it.
BUCKET, RECALL, ROTATIONS = 64, 0.997, 64
#: Rows of a bucket or group compared in one task at most; rows of a hot bucket's block.
LIMIT, BLOCK = 512, 512


class Index(NamedTuple):
    """Centre, one projection a rotation, bits of a table, number of tables, Hamming radius."""
    centre: np.ndarray
    projections: list
    bits: int
    tables: int
    radius: int

    def code(self, u: np.ndarray) -> np.ndarray:
        """Code bits (rows x tables x bits) of unit vectors."""
        x = u - self.centre
        signs = np.concatenate([x @ p > 0 for p in self.projections] or [np.zeros((len(u), 0), bool)], axis=1)
        return signs[:, :self.bits * self.tables].reshape(len(u), self.tables, self.bits)


def learn_rotation(v: np.ndarray, rng: np.random.Generator, rounds: int = ROUNDS) -> np.ndarray:
    """The rotation whose signs quantise the rows of ``v`` best, from a random start."""
    r = np.linalg.qr(rng.normal(size=(v.shape[1], v.shape[1])))[0]
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.where(v @ r > 0, 1.0, -1.0).T @ v)
        r = (left @ right).T
    return r


def pairs_at(u: np.ndarray, cosine: float, rng: np.random.Generator) -> np.ndarray:
    """For each unit row a unit vector at exactly this cosine, in a random direction."""
    side = rng.normal(size=u.shape)
    side -= (side * u).sum(axis=1, keepdims=True) * u
    norm = np.sqrt((side * side).sum(axis=1, keepdims=True))
    if u.shape[1] < 2:
        return u.copy()
    return cosine * u + math.sqrt(max(0.0, 1 - cosine * cosine)) * side / np.maximum(norm, 1e-300)


def learn_index(sample: np.ndarray, rows: int, cosine: float, seed: int = 3, bucket: int = BUCKET,
                recall: float = RECALL) -> Index:
    """Learn the tables for ``rows`` vectors from a sample of unit vectors."""
    rng = np.random.default_rng(seed)
    centre = sample.mean(axis=0)
    x = sample - centre
    width = min(DIRECTIONS, sample.shape[1])
    directions = np.linalg.svd(x.T @ x)[0][:, :width]
    made = pairs_at(sample, cosine, rng)
    projections: list = []
    for bits in range(max(0, round(math.log2(max(1, rows) / bucket))), 0, -1):
        while True:
            tables = width * len(projections) // bits
            if tables:
                full = Index(centre, projections, bits, tables, 0)
                a, b = full.code(sample), full.code(made)
                met = np.maximum.accumulate((a == b).all(axis=2), axis=1).mean(axis=0)
                enough = np.flatnonzero(met >= recall)
                if len(enough):
                    tables = int(enough[0]) + 1
                    apart = (a != b)[:, :tables].sum(axis=(1, 2))
                    radius = math.ceil(apart.mean() + 6 * apart.std())
                    return Index(centre, projections[:-(-tables * bits // width)], bits, tables, radius)
            if len(projections) >= ROTATIONS:
                break
            projections.append(directions @ learn_rotation(x @ directions, rng))
    return Index(centre, [], 0, 1, 0)


def _scaled(values: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings the largest component near 1: squares neither over- nor underflow."""
    _, e = np.frexp(np.abs(values).max(axis=1, initial=0.0))
    return np.ldexp(values, -e[:, None])


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _prepared(kind: str):
    """(vec_id, v) -> (vec_id, dim, h, x): the vector as bytes; nulls where it takes no part."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            dims, hashes, blobs = [], [], []
            for v in batch.column(1):
                x = None
                if v.is_valid and not v.values.null_count:
                    x = np.asarray(v.values, dtype=kind)
                    if not len(x) or not np.isfinite(x).all() or not x.any():
                        x = None
                if x is not None and kind == "f8":
                    x = _scaled(x[None, :])[0]
                blob = None if x is None else (x + x.dtype.type(0)).tobytes()  # -0.0 becomes 0.0
                dims.append(None if x is None else len(x))
                hashes.append(None if x is None else hashlib.blake2b(blob, digest_size=16).digest())
                blobs.append(blob)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dims, pa.int32()), pa.array(hashes, pa.binary()),
                                              pa.array(blobs, pa.binary())], ["vec_id", "dim", "h", "x"])
    return run


def _vectors(column, kind: str) -> np.ndarray:
    """Stored vectors as rows of doubles."""
    blobs = column.to_pylist()
    return np.frombuffer(b"".join(blobs), kind).reshape(len(blobs), -1).astype(float)


def _coded(index: Index, kind: str):
    """(rid, x) -> (rid, code, keys): the packed code and one bucket key a table."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        place = np.int64(1) << np.arange(index.bits, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                code = index.code(_unit(_vectors(part.column(1), kind)))
                packed = np.packbits(code.reshape(len(code), -1), axis=1)
                keys = (code * place).sum(axis=2, dtype=np.int64)
                offsets = np.arange(len(code) + 1, dtype=np.int32) * index.tables
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([c.tobytes() for c in packed], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))], ["rid", "code", "keys"])
    return run


def _codes(column) -> np.ndarray:
    """Packed codes as rows of bytes."""
    blobs = column.to_pylist()
    return np.frombuffer(b"".join(blobs), np.uint8).reshape(len(blobs), -1)


def _near(radius: int):
    """Rows (t, key, rid, code) sorted by bucket -> rows with a partner in the radius: (t, key, x, rid).

    ``x`` is the least row id of those that hang together in the bucket.
    """
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for t in _runs(batches, 2):
            table, key, rid = (t.column(c).to_numpy() for c in range(3))
            codes = _codes(t.column(3))
            pad = -codes.shape[1] % 8
            words = np.pad(codes, ((0, 0), (0, pad))).view(np.uint64) if codes.shape[1] else np.zeros((len(codes), 1),
                                                                                                    np.uint64)
            start = _starts([table, key])
            at, groups = [], []
            for s, e in zip(start, [*start[1:], len(rid)], strict=True):
                if e - s < 2:
                    continue
                own = words[s:e]
                linked = np.empty((e - s, e - s), bool)
                for i in range(0, e - s, 256):
                    apart = np.bitwise_count(own[i:i + 256, None, :] ^ own[None, :, :]).sum(axis=2, dtype=np.int32)
                    linked[i:i + 256] = apart <= radius
                some = np.flatnonzero(linked.sum(axis=1) > 1)
                if not len(some):
                    continue
                linked, label = linked[np.ix_(some, some)], np.arange(len(some))
                while True:
                    low = np.where(linked, label[None, :], len(some)).min(axis=1)
                    if (low == label).all():
                        break
                    label = low
                at.append(some + s)
                groups.append(rid[some + s][label])
            if at:
                rows = np.concatenate(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(table[rows], pa.int32()), pa.array(key[rows]), pa.array(np.concatenate(groups)),
                     pa.array(rid[rows])], ["t", "key", "x", "rid"])
    return run


def _rerank(cosine: float, index: Index, kind: str):
    """Groups (t, key, x, y, rid, side, ball, members, code, v) -> (a, b, n): links of a, and forest edges a-b.

    Two sides: pairs across them; one side: all pairs. Pairs of one ball were counted before, pairs
    that met in an earlier table are counted there.
    """
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for t in _runs(batches, 4):
            keys = [t.column(c).to_numpy() for c in range(4)]
            table, (rid, side, ball, members) = keys[0], (t.column(c).to_numpy() for c in range(4, 8))
            start = _starts(keys)
            out = []
            for s, e in zip(start, [*start[1:], len(rid)], strict=True):
                sides = side[s:e]
                one = np.flatnonzero(sides == 0)
                two = np.flatnonzero(sides == 1) if sides.any() else one
                if not len(one) or not len(two) or e - s < 2:
                    continue
                x = _vectors(t.column(9).slice(s, e - s), kind)
                norm = np.sqrt((x * x).sum(axis=1))
                close = (x[one] @ x[two].T) / (norm[one][:, None] * norm[two][None, :]) >= cosine
                if two is one:
                    close = np.triu(close, 1)
                i, j = np.nonzero(close)
                i, j = one[i], two[j]
                ok = (ball[s + i] != ball[s + j]) | (ball[s + i] < 0)
                i, j = i[ok], j[ok]
                if not len(i):
                    continue
                bits = np.unpackbits(_codes(t.column(8).slice(s, e - s)), axis=1)[:, :index.tables * index.bits]
                for at in range(0, len(i), 1 << 16):
                    a, b = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
                    apart = (bits[a] != bits[b]).reshape(len(a), index.tables, index.bits)
                    good = apart.sum(axis=(1, 2)) <= max(index.radius, 0 if index.bits else 1)
                    good &= (~apart.any(axis=2)).argmax(axis=1) == table[s]
                    i[at:at + (1 << 16)] = np.where(good, a, -1)
                i, j = i[i >= 0], j[i >= 0]
                n = np.zeros(e - s, np.int64)
                np.add.at(n, i, members[s + j])
                np.add.at(n, j, members[s + i])
                some = np.flatnonzero(n)
                out.append((rid[s + some], np.full(len(some), -1), n[some]))
                place = np.full(e - s, -1)
                place[some] = np.arange(len(some))
                linked = np.zeros((len(some), len(some)), bool)
                linked[place[i], place[j]] = linked[place[j], place[i]] = True
                forest = np.array(_forest(linked), np.int64).reshape(-1, 2)
                out.append((rid[s + some[forest[:, 0]]], rid[s + some[forest[:, 1]]], np.zeros(len(forest), np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64())
                                                  for c in zip(*out, strict=True)], ["a", "b", "n"])
    return run


def _centroid_sums(kind: str):
    """Rows (t, key, x) -> the sum of the unit vectors of each bucket in this task."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sums: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            u = _unit(_vectors(batch.column(2), kind))
            for i, k in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                sums[k] = sums[k] + u[i] if k in sums else u[i]
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int64()),
                 pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["t", "key", "s"])
    return run


def _inside(half_angle: float, kind: str):
    """Rows (rid, centre, x, centroid) -> (rid, centre) of vectors within the half angle of the centroid."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        least = math.cos(half_angle)
        for batch in batches:
            if not batch.num_rows:
                continue
            u = _unit(_vectors(batch.column(2), kind))
            c = np.array(batch.column(3).to_pylist(), float)
            norm = np.sqrt((c * c).sum(axis=1))
            near = (u * c).sum(axis=1) >= least * np.maximum(norm, 1e-300)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)],
                                             ["rid", "ball"]).filter(pa.array(near))
    return run


class _Hot(NamedTuple):
    groups: DataFrame  # rows to rerank: t, key, x, y, rid, side, ball
    counted: DataFrame  # a, b, n of the balls
    balls: DataFrame  # rid, ball


def _hot_groups(hot: DataFrame, reps: DataFrame, cosine: float, block: int, kind: str) -> _Hot:
    """Rows (t, key, rid) of hot buckets -> balls, and the pairs of blocks that are left to compare."""
    placed = hot.join(reps.select("rid", "x"), "rid").select("t", "key", "x", "rid")
    sums = placed.select("t", "key", "x").mapInArrow(_centroid_sums(kind), "t int, key long, s array<double>")
    summed = (sums.select("t", "key", F.posexplode("s").alias("i", "s")).groupBy("t", "key", "i").agg(F.sum("s").alias("s"))
              .groupBy("t", "key").agg(F.sort_array(F.collect_list(F.struct("i", "s"))).alias("s")))
    centroids = store(summed.select("t", "key", F.col("s.s").alias("s"))
                      .withColumn("ball", F.monotonically_increasing_id()), "centroids")
    # A hair under half of the angle, so that rounding admits no pair below the wanted cosine.
    half = math.acos(min(1.0, cosine)) / 2 - 1e-9
    balls = (placed.join(centroids, ["t", "key"]).select("rid", "ball", "x", "s")
             .mapInArrow(_inside(half, kind), "rid long, ball long").groupBy("rid").agg(F.min("ball").alias("ball")))
    balls = store(balls, "balls")
    sized = balls.join(reps.select("rid", "members"), "rid").groupBy("ball").agg(
        F.sum("members").alias("total"), F.min("rid").alias("hub"))
    counted = (balls.join(sized, "ball").join(reps.select("rid", "members"), "rid")
               .select(F.col("rid").alias("a"), F.col("hub").alias("b"), (F.col("total") - F.col("members")).alias("n")))
    rows = hot.join(balls, "rid", "left").withColumn("ball", F.coalesce("ball", F.lit(-1)))
    sizes = rows.groupBy("t", "key", "ball").agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("slots"))
    rows = rows.join(sizes, ["t", "key", "ball"]).withColumn("slot", F.pmod(F.xxhash64("rid"), F.col("slots")))
    rows = store(rows.select("t", "key", "ball", "slot", "rid"), "hot-rows")
    blocks = store(rows.select("t", "key", "ball", "slot").distinct().withColumn("no", F.monotonically_increasing_id()),
                   "hot-blocks")
    other = blocks.select("t", "key", F.col("ball").alias("ball2"), F.col("no").alias("y"))
    pairs = (blocks.join(other, ["t", "key"]).where("no <= y and (ball <> ball2 or ball < 0)")
             .select("t", "key", F.col("no").alias("x"), "y"))
    sides = (pairs.select("t", "key", "x", "y", F.col("x").alias("no"), F.lit(0).alias("side"))
             .unionByName(pairs.where("x < y").select("t", "key", "x", "y", F.col("y").alias("no"), F.lit(1).alias("side"))))
    placed_rows = rows.join(blocks, ["t", "key", "ball", "slot"]).select("no", "rid", "ball")
    return _Hot(sides.join(placed_rows, "no").select("t", "key", "x", "y", "rid", "side", "ball"), counted, balls)


def _links(reps: DataFrame, kind: str, cosine: float, limit: int, block: int, bucket: int) -> DataFrame:
    """(a, b, n) over representatives of one vector length: links of a when b is -1, else an edge too."""
    rows = reps.count()
    dim = reps.select("dim").first()["dim"]
    take = max(256, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * dim)))
    sample = reps.select("rid", "x").orderBy(F.xxhash64("rid"), "rid").limit(take).collect()
    index = learn_index(_unit(np.array([np.frombuffer(r["x"], kind) for r in sample], float)), rows, cosine, bucket=bucket)
    coded = store(reps.select("rid", "x").mapInArrow(_coded(index, kind), "rid long, code binary, keys array<long>"), "codes")
    entries = coded.select("rid", "code", F.posexplode("keys").alias("t", "key"))
    sizes = entries.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n"))
    crowded = store(sizes.where(F.col("n") > limit).select("t", "key"), "hot-buckets")
    small = entries if crowded.isEmpty() else entries.join(crowded, ["t", "key"], "left_anti")
    near = (small.select("t", "key", "rid", "code").repartition("t", "key").sortWithinPartitions("t", "key")
            .mapInArrow(_near(index.radius), "t int, key long, x long, rid long"))
    groups = near.select("t", "key", "x", F.lit(-1).cast("long").alias("y"), "rid", F.lit(0).alias("side"),
                         F.lit(-1).cast("long").alias("ball"))
    counted = None
    if not crowded.isEmpty():
        hot = store(entries.join(crowded, ["t", "key"], "left_semi").select("t", "key", "rid"), "hot-entries")
        work = _hot_groups(hot, reps, cosine, block, kind)
        # Pairs of one ball may also meet in a bucket that is not hot.
        groups = (groups.drop("ball").join(work.balls, "rid", "left").withColumn("ball", F.coalesce("ball", F.lit(-1)))
                  .select(*work.groups.columns).unionByName(work.groups))
        counted = work.counted
    found = (groups.join(reps.select("rid", "members", "x").withColumnRenamed("x", "v"), "rid")
             .join(coded.select("rid", "code"), "rid")
             .select("t", "key", "x", "y", "rid", "side", "ball", "members", "code", "v")
             .repartition("t", "key", "x", "y").sortWithinPartitions("t", "key", "x", "y")
             .mapInArrow(_rerank(cosine, index, kind), "a long, b long, n long"))
    found = store(found if counted is None else found.unionByName(counted), "vector-links")
    for old in (coded, crowded):
        discard(old)
    return found


def near_vectors(table: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding",
                 limit: int = LIMIT, block: int = BLOCK, bucket: int = BUCKET) -> DataFrame:
    """Vectors linked by cosine: (vec_id, n_links, component_id, kept), one row per input row.

    Two vectors are linked when their cosine in double precision is ``cosine`` or more; no link
    below it is made, and of those at exactly the threshold about 99.7 % are found, above it
    more. ``n_links`` counts the other rows linked directly (copies each), ``component_id`` is
    the smallest id reachable, ``kept`` holds for rows with that id. Vectors that are null, empty
    or all zero, or hold a null, NaN or infinity, link with nothing and keep themselves. Vectors
    of different lengths are never linked; each length has an index of its own. A null id is no
    component's smallest unless it has no other. Repeated rows are copies. An empty table gives
    an empty result. Extra columns are ignored.
    """
    v = table[vector_col]
    kind = "f4" if table.select(v.alias("v")).schema["v"].dataType.elementType.typeName() == "float" else "f8"
    named = table.select(table[id_col].cast("long").alias("vec_id"),
                         (v if kind == "f4" else v.cast("array<double>")).alias("v"))
    rows = store(named.mapInArrow(_prepared(kind), "vec_id long, dim int, h binary, x binary"), "prepared")
    reps = store(rows.where("h is not null").groupBy("h").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("members"), F.first("dim").alias("dim"),
        F.first("x").alias("x")).withColumn("rid", F.monotonically_increasing_id()), "vector-classes")
    links = None
    for dim in [r["dim"] for r in reps.select("dim").distinct().orderBy("dim").collect()]:
        one = _links(reps.where(F.col("dim") == dim), kind, cosine, limit, block, bucket)
        links = one if links is None else links.unionByName(one)
    if links is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    counts = links.groupBy(F.col("a").alias("rid")).agg(F.sum("n").alias("n"))
    joined = components(links.where("b >= 0 and a <> b"))
    named = (reps.select("h", "rid", "least", "members").join(counts, "rid", "left")
             .join(joined.select(F.col("node").alias("rid"), "comp"), "rid", "left")
             .withColumn("comp", F.coalesce("comp", "rid")))
    named = store(named, "named-vectors")
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    ids = named.join(least, "comp").select(
        "h", (F.coalesce("n", F.lit(0)) + F.col("members") - 1).alias("n_links"), "component_id")
    component = F.when(F.col("h").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (rows.select("vec_id", "h").join(ids, "h", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                    F.col("vec_id").eqNullSafe(component).alias("kept")))
