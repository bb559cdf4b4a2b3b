"""Joins and set operations.

Broadcast is used only where the small side has a proven bound (a top-N list). Everything else is
left to the planner: with AQE on, a side that turns out small at runtime is
broadcast, and a skewed partition of a sort-merge join is split (skewJoin).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def natural_join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Join on every column name the two frames share."""
    common = [c for c in a.columns if c in set(b.columns)]
    if not common:
        raise ValueError("natural join needs at least one common column")
    return a.join(b, on=common, how=how)


def keyed_left_join(a: DataFrame, b: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Attach b's columns to a by key, never by position."""
    return a.join(b, on=key, how="left")


def suffix_join(a: DataFrame, b: DataFrame, on: str | Sequence[str], suffix: str,
                how: str = "inner") -> DataFrame:
    """Join where b's overlapping non-key columns get ``suffix``."""
    keys = [on] if isinstance(on, str) else list(on)
    overlap = set(a.columns) & set(b.columns) - set(keys)
    b2 = b.select(*[F.col(c).alias(f"{c}{suffix}") if c in overlap else F.col(c) for c in b.columns])
    return a.join(b2, on=keys, how=how)


def first_match(dim: DataFrame, key: str, order: str) -> DataFrame:
    """One dimension row per key: the first by ``order`` (search result [0]).

    ``min_by`` over a struct is a partial aggregate, so a key holding a third of
    the dimension is pre-combined per task, never gathered into one.
    """
    others = [c for c in dim.columns if c != key]
    best = F.min_by(F.struct(*others), F.col(order))
    return dim.groupBy(key).agg(best.alias("_m")).select(key, "_m.*")


def enrich(df: DataFrame, dim: DataFrame, on: str, order: str, tags_col: str,
           tag_name: str = "tag") -> DataFrame:
    """Left join each row to the first matching dimension row and explode its tag
    array; a failed lookup keeps the row with a NULL tag (J8)."""
    m = first_match(dim, on, order)
    joined = df.join(m, on=on, how="left")
    return joined.select(*[c for c in joined.columns if c != tags_col],
                         F.explode_outer(tags_col).alias(tag_name))


def anti_rest(df: DataFrame, sample: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows not in the sample, matched by key."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.join(sample.select(*keys), on=keys, how="left_anti")


def union_parts(parts: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name (U1); with ``allow_missing`` absent columns are NULL."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=allow_missing)
    return out
