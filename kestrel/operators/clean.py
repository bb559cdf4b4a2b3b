"""Cleaning and imputation (C1-C9): constant fills, clipping, rule tables, null
tokens and mode imputation, all as one projection over the input."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import fill_nan


@dataclass(frozen=True)
class Rule:
    """Per-column cleaning rule, applied in the order replace -> fill -> clip -> cast."""

    fill: object | None = None
    clip_upper: float | None = None
    cast: str | None = None
    replace: tuple | None = None  # (old, new)


# The loan-data cleaning table (column: fill, upper clip, cast, replace),
# in the order the loan trainer applies them.
LOAN_RULES: dict[str, Rule] = {
    "emp_length": Rule(fill=1, clip_upper=10, cast="bigint"),
    "home_ownership": Rule(replace=("NONE", "OTHER")),
    "annual_inc": Rule(fill=58000, clip_upper=250000),
    "delinq_2yrs": Rule(fill=0, clip_upper=3, cast="bigint"),
    "inq_last_6mths": Rule(fill=0, clip_upper=4, cast="bigint"),
    "mths_since_last_delinq": Rule(fill=120.0),
    "mths_since_last_record": Rule(fill=0.0),
    "open_acc": Rule(fill=7, cast="bigint"),
    "pub_rec": Rule(fill=0, clip_upper=1, cast="bigint"),
    "revol_bal": Rule(clip_upper=100000),
    "revol_util": Rule(fill=0),
    "total_acc": Rule(fill=1, cast="bigint"),
}


def clip_upper(col: Column | str, bound) -> Column:
    """Upper clip that keeps NULL (``least(NULL, b)`` would return b)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isNull(), c).otherwise(F.least(c, F.lit(bound)))


def replace_value(col: Column | str, old, new) -> Column:
    """Replace one value by another (C4)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c == F.lit(old), F.lit(new)).otherwise(c)


def rule_column(name: str, rule: Rule) -> Column:
    c = F.col(name)
    if rule.replace is not None:
        c = replace_value(c, *rule.replace)
    if rule.fill is not None:
        c = F.coalesce(c, F.lit(rule.fill))
    if rule.clip_upper is not None:
        c = clip_upper(c, rule.clip_upper)
    if rule.cast is not None:
        c = c.cast(rule.cast)
    return c.alias(name)


def apply_rules(df: DataFrame, rules: Mapping[str, Rule]) -> DataFrame:
    """Fill -> clip -> cast chain from a rule table, in ONE select."""
    return df.select(*[rule_column(c, rules[c]) if c in rules else F.col(c) for c in df.columns])


def fill_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Per-column constant fill, NaN included for floating columns."""
    types = dict(df.dtypes)
    out = []
    for c in df.columns:
        if c not in values:
            out.append(F.col(c))
            continue
        if types[c] in ("double", "float"):
            out.append(fill_nan(c, F.lit(values[c]).cast(types[c])).alias(c))
        else:
            out.append(F.coalesce(F.col(c), F.lit(values[c]).cast(types[c])).alias(c))
    return df.select(*out)


def tokens_to_null(df: DataFrame, tokens: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """Null tokens (e.g. ' ?') become NULL in every string column."""
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    cols = [c for c in (cols or df.columns) if c in strings]
    toks = [F.lit(t) for t in tokens]
    return df.select(*[F.when(F.col(c).isin(*toks), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def column_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mode of several columns in one shuffle: unpivot to (column, value), count per
    pair (partial aggregation first), keep the largest count; ties go to the smallest
    value, compared as numbers for numeric columns and as text otherwise."""
    types = dict(df.dtypes)
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"),
                 (F.col(c).cast("double") if types[c] in numeric else F.lit(None).cast("double")).alias("num"))
        for c in cols
    ])).alias("kv")).select("kv.column", "kv.value", "kv.num").filter(F.col("value").isNotNull())
    counts = long.groupBy("column", "value", "num").agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by("value", F.struct((-F.col("n")).alias("n"), F.col("num"), F.col("value").alias("v")))
    return counts.groupBy("column").agg(best.alias("mode"))


def impute_mode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill NULLs of each column with the column mode.

    The modes table has one row per column (bounded by the schema), so it is read to
    the driver and inlined as literals.
    """
    modes = {r["column"]: r["mode"] for r in column_modes(df, cols).collect()}
    types = dict(df.dtypes)
    return df.select(*[F.coalesce(F.col(c), F.lit(modes.get(c)).cast(types[c])).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in any of ``subset``."""
    return df.na.drop(subset=list(subset))


def canonical_label(col: Column | str, chars: str = ". ") -> Column:
    """Strip blanks and full stops from both ends: ' >50K.' -> '>50K' (C8)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.btrim(c, F.lit(chars))
