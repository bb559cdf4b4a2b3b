"""Reproducible splits and sampling.

Membership is a pure function of the row (a stable hash of the key, or a seeded
random number) so every split is computed in one narrow pass; only exact-proportion
splits (stratified, percent ranges) need positions, which come from the distributed
row index in ``ordering`` rather than a single-partition window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import stable_bucket
from .ordering import rank_within
from .reshape import vocabulary


def mod_split(df: DataFrame, key: str, n: int = 5, test_rem: int = 0, name: str = "part") -> DataFrame:
    """MOD(key, n) == test_rem -> 'test', else 'train' (L9)."""
    return df.withColumn(name, F.when(F.pmod(F.col(key), F.lit(n)) == test_rem, "test").otherwise("train"))


def hash_split(df: DataFrame, key: str, weights: Sequence[tuple[str, int]], buckets: int = 10,
               name: str = "part") -> DataFrame:
    """Stable hash buckets 0..buckets-1 assigned to named parts by consecutive
    counts, e.g. [('train', 8), ('valid', 1), ('test', 1)] (L10, L14)."""
    b = stable_bucket(key, buckets)
    expr, lo = None, 0
    for part, w in weights:
        cond = (b >= lo) & (b < lo + w)
        expr = F.when(cond, F.lit(part)) if expr is None else expr.when(cond, F.lit(part))
        lo += w
    if lo != buckets:
        raise ValueError("weights must add up to the bucket count")
    return df.withColumn(name, expr)


def seeded_hash(key: Column | str, seed: int) -> Column:
    """md5 of (key, seed): a seeded, reproducible pseudo-random order key."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws("-", k.cast("string"), F.lit(str(seed))))


def stratified_split(df: DataFrame, label: str, key: str, fractions: Sequence[tuple[str, float]],
                     seed: int = 0, name: str = "part") -> DataFrame:
    """Exact per-class proportions (L11): rows of each class are ordered by a seeded
    hash; the first floor(f1*n_c) go to part 1, the next floor(f2*n_c) to part 2, the
    rest to the last part. Positions come from one distributed row index over
    (class, hash, key) minus the class's start offset (a per-class count table,
    bounded by the number of classes), so a class holding most rows is never pulled
    into one task."""
    h = df.withColumn("_h", seeded_hash(key, seed))
    ranked = rank_within(h, label, ["_h", key], "_pos")  # adds _pos and the class size _pos_n
    local = F.col("_pos")
    expr, acc = None, F.lit(0)
    for part, f in fractions[:-1]:
        acc = acc + F.floor(F.col("_pos_n") * F.lit(float(f)))
        expr = F.when(local < acc, F.lit(part)) if expr is None else expr.when(local < acc, F.lit(part))
    last = fractions[-1][0]
    expr = F.lit(last) if expr is None else expr.otherwise(F.lit(last))
    return ranked.withColumn(name, expr).drop("_h", "_pos", "_pos_n")


def split_counts(df: DataFrame, part: str = "part") -> DataFrame:
    """Row count per part and the conservation check against the input, in ONE
    aggregate (E18)."""
    parts = vocabulary(df, part, max_values=1000)  # a handful of part names (guarded)
    aggs = [F.count(F.when(F.col(part) == p, 1)).alias(f"n_{p}") for p in sorted(parts)]
    total = F.count(F.lit(1))
    out = df.agg(*aggs, total.alias("n_total"))
    return out.withColumn("conserved", sum((F.col(f"n_{p}") for p in sorted(parts)), F.lit(0)) == F.col("n_total"))


def time_split(df: DataFrame, ts: str, cut, inclusive: bool = True, name: str = "part") -> DataFrame:
    """Train = ts <= cut, test = ts >= cut when inclusive (a row at the cut lands in
    both parts, as the reference's label slicing does); half-open otherwise (L16)."""
    c = F.lit(cut).cast("timestamp_ntz") if isinstance(cut, str) else F.lit(cut)
    train = df.filter(F.col(ts) <= c) if inclusive else df.filter(F.col(ts) < c)
    test = df.filter(F.col(ts) >= c)
    return train.withColumn(name, F.lit("train")).unionByName(test.withColumn(name, F.lit("test")))


def date_range_split(df: DataFrame, col: str, windows: Sequence[tuple[str, str, str]],
                     name: str = "part") -> DataFrame:
    """Rows in each named [start day, end day] window, the end day included whole
    (L17); windows may share a boundary day."""
    d = F.col(col).cast("date")
    parts = [df.filter(d.between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))).withColumn(name, F.lit(p))
             for p, lo, hi in windows]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def kfold(df: DataFrame, key: str, k: int = 10, name: str = "fold") -> DataFrame:
    """Fold id 0..k-1 from a stable key hash."""
    return df.withColumn(name, stable_bucket(key, k).cast("int"))


def shuffle_rows(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Reproducible shuffle: order by a seeded hash of the key."""
    return df.withColumn("shuffle_key", seeded_hash(key, seed)).orderBy("shuffle_key", key)


def row_md5(df: DataFrame, seed: int, key: Sequence[str] | None = None) -> Column:
    """md5 of the seed and the row's ``key`` values (all values without one) as text, joined by
    '|' ('~' for NULL)."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in key or df.columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts).cast("binary"))


def sample_n(df: DataFrame, n: int, seed: int = 0, key: Sequence[str] | None = None) -> DataFrame:
    """n random rows (L6, L7): order by a seeded md5 of the row's key (of the whole row without
    one) and take n; each task keeps an n-row heap (TakeOrderedAndProject). The same rows at
    any partitioning."""
    return df.orderBy(row_md5(df, seed, key), *(key or df.columns)).limit(n)


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 0,
                 key: Sequence[str] | None = None) -> list[DataFrame]:
    """Seeded random fractions (L13, L14): each row's seeded md5 is a number in [0, 1), and the
    weights' running shares cut that range; the same rows at any partitioning."""
    at = F.conv(F.substring(row_md5(df, seed, key), 1, 8), 16, 10).cast("double") / float(1 << 32)
    total, low, parts = float(sum(weights)), 0.0, []
    for i, w in enumerate(weights):
        high = low + w / total
        parts.append(df.filter((at >= low) & (at < high) if i < len(weights) - 1 else at >= low))
        low = high
    return parts
