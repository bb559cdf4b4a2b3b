"""Fits that grow chunk by chunk (A16, T1, T2): a stored, mergeable state of each column.

A state is a small table, one row a column: counts, minimum, maximum, mean, centred second moment,
and two sketches (distinct values, quantiles). It is one aggregate over a chunk; two states merge
to the state of both chunks, so a later chunk updates a stored fit without the old rows. Scalers are
made from a state. Counts, minimum and maximum are those of the whole table exactly, mean and
second moment up to rounding; the sketches keep their own bounds (``QUANTILE_K``, ``DISTINCT_K``).
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .features import MinMax, Standardize

#: KLL parameter (400: ranks within about 0.7 %), base-2 logarithm of the distinct sketch's registers (14: about 0.8 %).
QUANTILE_K, DISTINCT_K = 400, 14

SCHEMA = ("column string, n long, missing long, low double, high double, mean double, m2 double, distinct binary, "
          "quantiles binary, chunks array<string>")


def _fold(parts: Column) -> Column:
    """Count, mean and centred second moment of a list of them, by the pairwise rule."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(a, b):
        n = a["n"] + b["n"]
        apart = b["mean"] - a["mean"]
        share = F.coalesce(F.try_divide(b["n"].cast("double"), n), F.lit(0.0))
        return F.struct(n.alias("n"), (a["mean"] + apart * share).alias("mean"),
                        (a["m2"] + b["m2"] + apart * apart * a["n"] * share).alias("m2"))

    return F.aggregate(parts, zero, add)


class FitState(NamedTuple):
    """Columns ``SCHEMA``: one row a column; NaN counts as missing."""
    rows: DataFrame

    @classmethod
    def of(cls, chunk: DataFrame, cols: Sequence[str], chunk_id: str | None = None) -> FitState:
        """The state of one chunk. An empty chunk gives counts of 0 and nulls."""
        made = []
        for c in cols:
            x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) + F.lit(0.0)
            made.append(F.struct(
                F.lit(c).alias("column"), F.count(x).alias("n"), F.count(F.when(x.isNull(), 1)).alias("missing"),
                F.min(x).alias("low"), F.max(x).alias("high"), F.avg(x).alias("mean"),
                (F.var_pop(x) * F.count(x)).alias("m2"), F.hll_sketch_agg(F.when(x.isNotNull(), F.xxhash64(x)),
                                                                         DISTINCT_K).alias("distinct"),
                F.kll_sketch_agg_double(x, QUANTILE_K).alias("quantiles"),
                F.array(*([F.lit(chunk_id)] if chunk_id is not None else [])).cast("array<string>").alias("chunks")))
        found = chunk.agg(*[m.alias(f"c{i}") for i, m in enumerate(made)])
        return cls(found.select(F.explode(F.array(*[f"c{i}" for i in range(len(made))])).alias("s")).select("s.*"))

    def merge(self, *others: FitState) -> FitState:
        """The state of all chunks together; columns that one of them lacks are taken from the rest."""
        rows = self.rows
        for o in others:
            rows = rows.unionByName(o.rows)
        part = F.struct("n", F.coalesce("mean", F.lit(0.0)).alias("mean"), F.coalesce("m2", F.lit(0.0)).alias("m2"))
        out = rows.groupBy("column").agg(
            F.sum("missing").alias("missing"), F.min("low").alias("low"), F.max("high").alias("high"),
            _fold(F.sort_array(F.collect_list(part))).alias("m"), F.hll_union_agg("distinct").alias("distinct"),
            F.kll_merge_agg_double("quantiles").alias("quantiles"),
            F.array_sort(F.flatten(F.collect_list("chunks"))).alias("chunks"))
        some = F.col("m.n") > 0
        return FitState(out.select("column", "m.n", "missing", "low", "high", F.when(some, F.col("m.mean")).alias("mean"),
                                   F.when(some, F.col("m.m2")).alias("m2"), "distinct", "quantiles", "chunks"))

    # -- stored states

    def save(self, path: str) -> None:
        """Write a new version of the state; readers see it when it is complete."""
        version = max(_versions(self.rows.sparkSession, path), default=-1) + 1
        self.rows.coalesce(1).write.parquet(f"{path}/v{version:08d}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FitState | None:
        """The newest complete version, or None."""
        found = _versions(spark, path)
        return cls(spark.read.schema(SCHEMA).parquet(f"{path}/v{max(found):08d}")) if found else None

    # -- what a state gives

    def min_max(self) -> MinMax:
        r = {x["column"]: x for x in self.rows.select("column", "low", "high").collect()}  # one row a column
        return MinMax({c: x["low"] for c, x in r.items()}, {c: x["high"] for c, x in r.items()})

    def standardize(self, ddof: int = 0) -> Standardize:
        sd = F.sqrt(F.col("m2") / F.nullif(F.col("n") - ddof, F.lit(0)))
        r = self.rows.select("column", "mean", sd.alias("sd")).collect()  # one row a column
        return Standardize({x["column"]: x["mean"] for x in r}, {x["column"]: x["sd"] or 1.0 for x in r})

    def summary(self, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
        """(column, n, missing, low, high, mean, std, distinct, q1..): moments, and estimates from the sketches."""
        est = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(q)))).alias(
            f"q{round(100 * q)}") for q in quantiles]
        return self.rows.select("column", "n", "missing", "low", "high", "mean",
                                F.sqrt(F.col("m2") / F.nullif(F.col("n") - 1, F.lit(0))).alias("std"),
                                F.hll_sketch_estimate("distinct").alias("distinct"), *est)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions under a path."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    Path = spark._jvm.org.apache.hadoop.fs.Path
    return [int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit() and fs.exists(Path(f"{path}/{n}/_SUCCESS"))]


def partial_fit(path: str, chunk: DataFrame, cols: Sequence[str], chunk_id: str) -> FitState:
    """Update the state stored at ``path`` by one chunk and return it.

    A chunk id that the state already holds changes nothing, so a job that failed behind the write
    can be run again.
    """
    spark = chunk.sparkSession
    old = FitState.load(spark, path)
    if old is not None and old.rows.where(F.array_contains("chunks", chunk_id)).count():
        return old
    new = FitState.of(chunk, cols, chunk_id)
    FitState(cut_lineage((old.merge(new) if old is not None else new).rows)).save(path)
    return FitState.load(spark, path)
