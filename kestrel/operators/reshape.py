"""Pivots, tag counters, cross-counts with margins and dummy columns.

Pivots always receive their value list (a fitted vocabulary), which saves the
distinct-values job and keeps the output schema fixed. The long form is kept until
the last step: wide frames are only produced from already-aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import as_cols


def vocabulary(df: DataFrame, col: str, max_values: int = 10_000) -> list:
    """Sorted distinct values of a category column (a fitted vocabulary).

    For wide outputs only: a vocabulary becomes column names, and ``max_values`` is the
    widest frame wanted; more values raise (nothing is dropped). The long forms
    (``group_count``, ``tag_counts_long``) take any number of values.
    """
    vals = df.select(col).distinct().filter(F.col(col).isNotNull()).limit(max_values + 1).collect()
    if len(vals) > max_values:
        raise ValueError(f"{col}: more than {max_values} distinct values; not a pivot vocabulary")
    return sorted(r[0] for r in vals)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _pivoted(df: DataFrame, key, col: str, vocab: list, cell: Column, fill=None) -> DataFrame:
    """One column per vocabulary value, named by ``str(value)``, at any vocabulary size.

    Spark's two-phase pivot: (key, value) cells are aggregated first (partial
    aggregation per task), then spread; absent cells are NULL or ``fill``.
    """
    keys = as_cols(key)
    out = df.groupBy(*keys).pivot(col, vocab).agg(cell)
    n = len(out.columns) - len(vocab)
    out = out.toDF(*out.columns[:n], *[str(v) for v in vocab])
    if fill is None:
        return out
    return out.select(*[F.col(_quoted(c)) for c in out.columns[:n]],
                      *[F.coalesce(F.col(_quoted(str(v))), F.lit(fill)).alias(str(v)) for v in vocab])


def pivot_values(df: DataFrame, key, col: str, value: str | Column, vocab: list,
                 agg: str = "first") -> DataFrame:
    """Long -> wide: one column per vocabulary value; absent pairs stay NULL."""
    v = F.col(value) if isinstance(value, str) else value
    fn = {"first": lambda e: F.first(e, ignorenulls=True), "sum": F.sum, "max": F.max}[agg]
    return _pivoted(df, key, col, vocab, fn(v))


def pivot_counts(df: DataFrame, key, col: str, vocab: list, fill: int | None = None) -> DataFrame:
    """Count of rows per key and value, wide; NULL for absent pairs unless ``fill``."""
    return _pivoted(df, key, col, vocab, F.count(F.lit(1)), None if fill is None else F.lit(fill).cast("long"))


def melt_long(wide: DataFrame, key: str, column: str = "column", value: str = "value") -> DataFrame:
    """A wide frame as long rows (key, column name, value): the form without a schema that
    depends on the data."""
    rest = [F.col(_quoted(c)) for c in wide.columns if c != key]
    return wide.unpivot([F.col(_quoted(key))], rest, column, value)


def tag_counts_long(plays: DataFrame, tags: DataFrame, user: str, item: str, tag: str) -> DataFrame:
    """Per (user, tag): number of distinct items the user played that carry the tag.

    The users x items x tags loop becomes an equi-join on the item and one grouped
    count; the plays are first reduced to distinct (user, item) pairs (pre-aggregation
    before the join shuffle).
    """
    pairs = plays.select(user, item).distinct()
    item_tags = tags.select(item, tag).distinct()
    # AQE broadcasts the item -> tag side when it turns out small, else splits a hot item's pairs
    return pairs.join(item_tags, item).groupBy(user, tag).agg(F.count(F.lit(1)).alias("n"))


def tag_matrix(df: DataFrame, key: str, tag: str, vocab: list) -> DataFrame:
    """Boolean matrix: True where the key carries the tag, else False."""
    return _pivoted(df, key, tag, vocab, F.bool_or(F.lit(True)), fill=False)


def crosstab(df: DataFrame, a: str, b: str, b_vocab: list, margins: bool = False,
             margin_name: str = "All", percent_of=None, drop_margin_row: bool = False) -> DataFrame:
    """Cross-count of two columns, zeros for absent cells (R5); with margins the
    ``All`` row and column are added from a CUBE in the same aggregate (R6, A20).
    ``percent_of=(value, name)`` adds round(100 * n[value] / All, 1), half-even like
    pandas; ``drop_margin_row`` removes the ``All`` row afterwards."""
    if not margins:
        return pivot_counts(df, a, b, b_vocab, fill=0)
    out = _crosstab_margins(df, a, b, b_vocab, margin_name)
    if percent_of is not None:
        v, name = percent_of
        out = out.withColumn(name, F.bround(100 * F.col(f"`{v}`") / F.col(f"`{margin_name}`"), 1))
    if drop_margin_row:
        out = out.filter(F.col(a) != F.lit(margin_name))
    return out


def _crosstab_margins(df: DataFrame, a: str, b: str, b_vocab: list, margin_name: str) -> DataFrame:
    cube = (df.cube(a, b).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("_g")))
    lab_a = F.when(F.col("_g").bitwiseAND(2) == 2, F.lit(margin_name)).otherwise(F.col(a).cast("string"))
    lab_b = F.when(F.col("_g").bitwiseAND(1) == 1, F.lit(margin_name)).otherwise(F.col(b).cast("string"))
    long = cube.select(lab_a.alias(a), lab_b.alias(b), "n")
    cols = [str(v) for v in b_vocab] + [margin_name]
    return long.groupBy(a).pivot(b, cols).agg(F.first("n")).fillna(0, subset=cols)


def one_hot_columns(col: str, vocab: list, prefix: str | None = None, sep: str = "_") -> list[Column]:
    """Dummy columns ``prefix_value`` as 0/1 ints over a fitted vocabulary, NULL gives 0."""
    p = col if prefix is None else prefix
    return [F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{p}{sep}{v}") for v in vocab]


def dummies(df: DataFrame, cols: dict[str, list], keep=(), sep: str = "_") -> DataFrame:
    """Replace category columns with dummy columns over given vocabularies."""
    out = [F.col(c) for c in df.columns if c not in cols] if not keep else [F.col(c) for c in keep]
    for c, vocab in cols.items():
        out += one_hot_columns(c, vocab, sep=sep)
    return df.select(*out)


def align_columns(df: DataFrame, columns: list[str], fill=0) -> DataFrame:
    """Make ``df`` carry exactly ``columns`` in order: absent ones as ``fill``,
    unseen ones dropped (R10)."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).alias(c) for c in columns])


def count_vector(df: DataFrame, key, cat: str, vocab: list, prefix: str) -> DataFrame:
    """Per-key count of each vocabulary value, missing -> 0, as named columns."""
    wide = pivot_counts(df, key, cat, vocab, fill=0)
    return wide.select(*as_cols(key), *[F.col(f"`{v}`").cast("long").alias(f"{prefix}{v}") for v in vocab])
