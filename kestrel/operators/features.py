"""Feature transformers as fit -> transform pairs.

A fit is one aggregate over the training rows; what it keeps is small by
construction (two numbers per column, or a vocabulary checked against a size bound)
and is applied as column expressions, so a transform is a narrow projection.
Vocabularies too large to inline stay DataFrames and are joined (label encoding).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ordering import global_row_index
from .reshape import vocabulary


@dataclass
class MinMax:
    """Min-max scaling fitted on train (T1). A constant column maps to 0 (as
    scikit-learn); test values may fall outside [0, 1]."""

    mins: dict[str, float] = field(default_factory=dict)
    maxs: dict[str, float] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> MinMax:
        aggs = []
        for c in cols:
            aggs += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
        r = df.agg(*aggs).first()
        return cls({c: r[f"{c}__min"] for c in cols}, {c: r[f"{c}__max"] for c in cols})

    def column(self, c: str) -> Column:
        lo, hi = self.mins[c], self.maxs[c]
        rng = (hi - lo) if hi is not None and lo is not None else None
        if not rng:
            return (F.col(c) - F.lit(lo)) * F.lit(0.0)
        return (F.col(c) - F.lit(lo)) / F.lit(rng)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[self.column(c).alias(c) if c in self.mins else F.col(c) for c in df.columns])


@dataclass
class Standardize:
    """(x - mean) / sd fitted on train (T2). ``ddof=0`` gives the population sd
    (scikit-learn); a zero sd scales by 1."""

    means: dict[str, float] = field(default_factory=dict)
    sds: dict[str, float] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], ddof: int = 0) -> Standardize:
        sd = F.stddev_pop if ddof == 0 else F.stddev_samp
        aggs = []
        for c in cols:
            aggs += [F.avg(c).alias(f"{c}__m"), sd(c).alias(f"{c}__s")]
        r = df.agg(*aggs).first()
        return cls({c: r[f"{c}__m"] for c in cols}, {c: (r[f"{c}__s"] or 1.0) for c in cols})

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[((F.col(c) - F.lit(self.means[c])) / F.lit(self.sds[c])).alias(c)
                           if c in self.means else F.col(c) for c in df.columns])


@dataclass
class LabelEncode:
    """Codes 0..k-1 in sorted value order, per column, fitted on train.

    The vocabulary is a DataFrame (column, value, code): codes come from one
    distributed row index over the sorted distinct values, minus each column's start
    offset, so a column with a huge vocabulary never lands in one task. Values unseen
    at fit time get NULL."""

    vocab: DataFrame
    cols: list[str]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> LabelEncode:
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols
        ])).alias("kv")).select("kv.*").filter(F.col("value").isNotNull()).distinct()
        # numbered once; a column's first position comes from the stored numbering itself
        idx = cut_lineage(global_row_index(long, ["column", "value"], "_pos"))
        starts = idx.groupBy("column").agg(F.min("_pos").alias("_start"))  # one row per column
        vocab = idx.join(starts, "column").select(
            "column", "value", (F.col("_pos") - F.col("_start")).cast("int").alias("code"))
        return cls(vocab, list(cols))

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        out = df
        for c in self.cols:
            v = self.vocab.filter(F.col("column") == c).select(
                F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"{c}{suffix or '__code'}"))
            out = out.join(v, F.col(c).cast("string") == F.col(f"_v_{c}"), "left").drop(f"_v_{c}")
            if not suffix:
                out = out.drop(c).withColumnRenamed(f"{c}__code", c)
        return out


@dataclass
class OneHot:
    """One-hot over the train vocabulary; unseen values give all zeros.

    ``transform`` adds an array<double> column per input (or wide ``col_value``
    dummies with ``wide=True``); ``ml_stages`` gives the equivalent Spark ML stages
    (StringIndexer keep-invalid + OneHotEncoder dropLast: the invalid slot is the
    dropped one, so unseen -> all zeros)."""

    vocabs: dict[str, list]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], max_values: int = 10_000) -> OneHot:
        return cls({c: vocabulary(df, c, max_values) for c in cols})

    def array_column(self, c: str) -> Column:
        return F.array(*[F.coalesce((F.col(c) == F.lit(v)).cast("double"), F.lit(0.0)) for v in self.vocabs[c]]) \
            if self.vocabs[c] else F.array().cast("array<double>")

    def transform(self, df: DataFrame, wide: bool = False, suffix: str = "_onehot", sep: str = "_") -> DataFrame:
        if wide:
            keep = [F.col(c) for c in df.columns if c not in self.vocabs]
            dummies = [F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}{sep}{v}")
                       for c in self.vocabs for v in self.vocabs[c]]
            return df.select(*keep, *dummies)
        return df.select("*", *[self.array_column(c).alias(f"{c}{suffix}") for c in self.vocabs])

    def wide_columns(self, sep: str = "_") -> list[str]:
        return [f"{c}{sep}{v}" for c in self.vocabs for v in self.vocabs[c]]

    def ml_stages(self, out_suffix: str = "_vec"):
        stages = []
        for c in self.vocabs:
            stages.append(StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep",
                                        stringOrderType="alphabetAsc"))
            stages.append(OneHotEncoder(inputCol=f"{c}_idx", outputCol=f"{c}{out_suffix}", dropLast=True))
        return stages


@dataclass
class RightClosedBins:
    """Bins (e0, e1], (e1, e2], ... by fixed edges, right-closed like ``pd.cut``;
    a value at or below the first edge (or NULL) gets NULL (T5). Spark's Bucketizer
    is left-closed, so this is a CASE chain."""

    edges: Sequence[float]

    def index(self, col: Column | str) -> Column:
        c = F.col(col) if isinstance(col, str) else col
        expr = None
        for i in range(len(self.edges) - 1):
            lo, hi = self.edges[i], self.edges[i + 1]
            cond = (c > F.lit(lo)) & (c <= F.lit(hi)) if not math.isinf(hi) else (c > F.lit(lo))
            expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
        return expr

    def label(self, col: Column | str) -> Column:
        c = F.col(col) if isinstance(col, str) else col
        expr = None
        for i in range(len(self.edges) - 1):
            lo, hi = self.edges[i], self.edges[i + 1]
            cond = (c > F.lit(lo)) & (c <= F.lit(hi)) if not math.isinf(hi) else (c > F.lit(lo))
            text = f"({float(lo)}, {'inf' if math.isinf(hi) else float(hi)}]"
            expr = F.when(cond, F.lit(text)) if expr is None else expr.when(cond, F.lit(text))
        return expr


# Working-hours bin edges of the income flow (six equal edges over
# 0..50, then an open top bin).
WORK_HOUR_EDGES = [0.0, 10.0, 20.0, 30.0, 40.0, 50.0, float("inf")]


def class_weight(df: DataFrame, label: str, ratio: float | None = None, base: float = 100.0,
                 name: str = "weight") -> DataFrame:
    """Per-row class weight (T9): class 0 -> base, class 1 -> round(ratio, 2) x base,
    where ratio defaults to majority : minority count from one aggregate."""
    if ratio is None:
        r = df.agg(F.sum((F.col(label) == 0).cast("long")).alias("n0"),
                   F.sum((F.col(label) == 1).cast("long")).alias("n1")).first()
        ratio = (r["n0"] / r["n1"]) if r["n1"] else 1.0
    w1 = round(ratio, 2) * base
    return df.withColumn(name, F.when(F.col(label) == 1, F.lit(w1)).otherwise(F.lit(base)))


def feature_array(scalars: Sequence[str], arrays: Sequence[str] = ()) -> Column:
    """Concatenate scalar and array<double> feature columns into one array."""
    return F.concat(F.array(*[F.col(c).cast("double") for c in scalars]), *[F.col(a) for a in arrays])


def assemble(df: DataFrame, inputs: Sequence[str], output: str = "features") -> DataFrame:
    """Spark ML vector assembly of numeric and vector columns."""
    return VectorAssembler(inputCols=list(inputs), outputCol=output, handleInvalid="keep").transform(df)
