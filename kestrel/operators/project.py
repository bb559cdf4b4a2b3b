"""Projections, predicates, CASE codes and labels.

All of these are column expressions: they compile into the scan's whole-stage
codegen span and let Catalyst push filters and column pruning into Parquet.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The ordered literal replacements applied to every column name by the
# artist-liking flow before its CSV export (applied in this order).
COLUMN_NAME_REPLACEMENTS: list[tuple[str, str]] = [
    ("post-roc", "post roc1"),
    ("trip-hop", "trip hop1"),
    (" ", "_"),
    ("/", ""),
    ("é", ""),
    ("ö", "o"),
    ("+", "_and_"),
    ("&", "and"),
    ("!", ""),
    ("-", "_"),
    (".", ""),
    ("ó", "o"),
    ("'", ""),
    ("久石譲", "Joe_Hisaishi"),
    ("川井憲次", "Kenji_Kawai"),
    ("梶浦由記", "Yuki_Kajiura"),
    ("植松伸夫", "Nobuo_Uematsu"),
    ("菅野よう子", "Yoko_Kanno"),
    ("近藤浩治", "Koji_Kondo"),
]

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def project_rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Select and rename columns in one projection."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def clean_name(name: str, replacements: Sequence[tuple[str, str]] = COLUMN_NAME_REPLACEMENTS) -> str:
    for old, new in replacements:
        name = name.replace(old, new)
    return name


def clean_names(df: DataFrame, replacements: Sequence[tuple[str, str]] = COLUMN_NAME_REPLACEMENTS) -> DataFrame:
    """Rewrite every column name by the ordered replacements (P5); metadata only."""
    return df.toDF(*[clean_name(c, replacements) for c in df.columns])


def select_by_type(df: DataFrame, kinds: Sequence[str]) -> list[str]:
    """Column names whose type is one of ``numeric``, ``string``, ``bool``, ``time``."""
    out = []
    for f in df.schema.fields:
        t = f.dataType
        kind = ("numeric" if isinstance(t, NUMERIC_TYPES) else
                "string" if isinstance(t, T.StringType) else
                "bool" if isinstance(t, T.BooleanType) else
                "time" if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)) else
                "other")
        if kind in kinds:
            out.append(f.name)
    return out


def columns_difference(columns: Sequence[str], remove: Sequence[str], first: str | None = None) -> list[str]:
    """Sorted column-set difference, optional target column first."""
    rest = sorted(set(columns) - set(remove) - ({first} if first else set()))
    return ([first] if first else []) + rest


def drop_header_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop stray header lines: rows where a column holds its own name (P10)."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    cond = F.lit(True)
    for c in cols:
        cond = cond & ~F.coalesce(F.col(c) == F.lit(c), F.lit(False))
    return df.filter(cond)


def ordinal_case(col: Column | str, mapping: Mapping[str, int], default_cast: bool = True,
                 default: int | None = None) -> Column:
    """CASE value -> ordinal code; other values are cast to int when they parse.

    ``try_cast`` keeps ANSI mode from raising on text such as ``4+``.
    """
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for k, v in mapping.items():
        expr = (F.when(c == F.lit(k), F.lit(v)) if expr is None else expr.when(c == F.lit(k), F.lit(v)))
    if default_cast:
        fallback = c.try_cast("int")
        if default is not None:
            fallback = F.coalesce(fallback, F.lit(default))
    else:
        fallback = F.lit(default)
    return fallback if expr is None else expr.otherwise(fallback)


def one_vs_rest(df: DataFrame, col: str, values: Sequence, prefix: str = "") -> DataFrame:
    """Add one 0/1 flag column per class value; NULL has 0 in all."""
    return df.select("*", *[F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{prefix}{v}")
                            for v in values])


def label_equals(col: Column | str, value: str, normalise: Callable[[Column], Column] | None = None) -> Column:
    """Boolean label ``col == value`` after an optional normalisation."""
    c = F.col(col) if isinstance(col, str) else col
    if normalise is not None:
        c = normalise(c)
    return c == F.lit(value)


def label_presence(df: DataFrame, source: str, label: str) -> DataFrame:
    """Label = source column is not null, then drop the source column."""
    return df.withColumn(label, F.col(f"`{source}`").isNotNull()).drop(source)


def map_values(col: Column | str, mapping: Mapping) -> Column:
    """Dict lookup; unmapped values become NULL."""
    c = F.col(col) if isinstance(col, str) else col
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)[c] if pairs else F.lit(None)


def zero_indicator(col: str, suffix: str = "_zero") -> Column:
    """1 when the value is 0, else 0, NULL included."""
    return F.coalesce((F.col(col) == 0).cast("int"), F.lit(0)).alias(f"{col}{suffix}")


def threshold_flag(score: Column | str, t: float, strict: bool = False) -> Column:
    """0/1 from a score: ``>= t`` or, strictly, ``> t``."""
    s = F.col(score) if isinstance(score, str) else score
    return F.when((s > t) if strict else (s >= t), F.lit(1)).otherwise(F.lit(0))


def point_lookup(df: DataFrame, key: str, value, col: str) -> DataFrame:
    """Single cell by key: ``filter(key == v).select(col)``."""
    return df.filter(F.col(key) == F.lit(value)).select(key, col)
