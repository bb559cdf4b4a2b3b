"""Global order without a single-partition window.

``Window.orderBy(...)`` with no partition key pulls every row into one task. These
helpers number rows of a total order in a distributed way instead:

1. range-partition on the order and sort inside each partition (one shuffle);
2. number rows inside a partition from ``monotonically_increasing_id`` (its low 33
   bits are the record number in the task, its high bits the partition id);
3. write that numbered, range-partitioned result once with a reliable checkpoint
   (the shared ``spark.checkpoint.dir``): the per-partition counts and the rows are
   then read from the same files, so a recomputation (retry, lost executor, a second
   sampling of the range bounds) can never make the two disagree;
4. add the row count of all earlier partitions, taken from a per-partition count
   table whose size is the partition count (a proven bound, so it is broadcast).

The order columns must form a total order (add a unique key as the last column) so
that the numbering is deterministic across retries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def as_cols(cols) -> list[Column]:
    if isinstance(cols, (str, Column)):
        cols = [cols]
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def global_row_index(df: DataFrame, order, name: str = "row_idx",
                     num_partitions: int | None = None, total: str | None = None) -> DataFrame:
    """Append a 0-based position of each row in ``order`` (a list of columns).

    With ``total`` set, also append the table's row count under that name (it comes
    from the same per-partition count table, so no extra pass over the data).
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = as_cols(order)
    ranged = df.repartitionByRange(n, *ordered).sortWithinPartitions(*ordered)
    local = cut_lineage(ranged
                        .withColumn("_k_pid", F.spark_partition_id())
                        .withColumn("_k_local", F.monotonically_increasing_id()
                                    - F.shiftleft(F.col("_k_pid").cast("long"), 33)))
    # one row per partition: bounded by the partition count, never by the data
    counts = local.groupBy("_k_pid").agg(F.count(F.lit(1)).alias("_k_n"))
    running = Window.orderBy("_k_pid").rowsBetween(Window.unboundedPreceding, -1)
    cols = ["_k_pid", F.coalesce(F.sum("_k_n").over(running), F.lit(0)).alias("_k_off")]
    if total:
        cols.append(F.sum("_k_n").over(Window.partitionBy()).alias(total))
    offsets = counts.select(*cols)
    out = (local.join(F.broadcast(offsets), "_k_pid")
           .withColumn(name, F.col("_k_off") + F.col("_k_local")))
    return out.drop("_k_pid", "_k_local", "_k_off")


def row_index(df: DataFrame, order, name: str = "row_idx") -> DataFrame:
    """0..n-1 position after a sort."""
    return global_row_index(df, order, name)


def chunk_ids(df: DataFrame, order, size: int, name: str = "chunk_id") -> DataFrame:
    """Fixed-size chunks of an ordered table: chunk = floor(position / size)."""
    idx = global_row_index(df, order, "_k_pos")
    return idx.withColumn(name, F.floor(F.col("_k_pos") / F.lit(size)).cast("long")).drop("_k_pos")


def percent_range(df: DataFrame, order, lo: float, hi: float) -> DataFrame:
    """Rows whose position lies in [lo%, hi%) of the ordered table.

    Position p (0-based) of n rows is kept when floor(n*lo/100) <= p < floor(n*hi/100),
    the integer cut points of ``[lo%:hi%]`` slicing.
    """
    idx = global_row_index(df, order, "_k_pos", total="_k_total")
    lo_cut = F.floor(F.col("_k_total") * F.lit(float(lo)) / F.lit(100.0))
    hi_cut = F.floor(F.col("_k_total") * F.lit(float(hi)) / F.lit(100.0))
    return (idx.filter((F.col("_k_pos") >= lo_cut) & (F.col("_k_pos") < hi_cut))
            .drop("_k_pos", "_k_total"))


def global_running_sum(df: DataFrame, order, values, suffix: str = "_cum",
                       num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``values`` along a total order, without a one-task
    window: range-partition on the order (checkpointed once, as in
    ``global_row_index``), sum inside each partition (a window partitioned by the
    partition id), then add the totals of all earlier partitions from a
    per-partition table (bounded by the partition count, broadcast)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = as_cols(order)
    vals = [values] if isinstance(values, str) else list(values)
    ranged = cut_lineage(df.repartitionByRange(n, *ordered).withColumn("_k_pid", F.spark_partition_id()))
    w = Window.partitionBy("_k_pid").orderBy(*ordered).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", *[F.sum(v).over(w).alias(f"_k_loc_{v}") for v in vals])
    totals = ranged.groupBy("_k_pid").agg(*[F.sum(v).alias(f"_k_tot_{v}") for v in vals])
    before = Window.orderBy("_k_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_k_pid", *[F.coalesce(F.sum(f"_k_tot_{v}").over(before), F.lit(0)).alias(f"_k_off_{v}")
                                        for v in vals])
    out = local.join(F.broadcast(offsets), "_k_pid")
    out = out.select("*", *[(F.col(f"_k_loc_{v}") + F.col(f"_k_off_{v}")).alias(f"{v}{suffix}") for v in vals])
    return out.drop("_k_pid", *[f"_k_loc_{v}" for v in vals], *[f"_k_off_{v}" for v in vals])


def rank_within(df: DataFrame, group: str, order, name: str = "pos") -> DataFrame:
    """0-based position inside each group along ``order`` (group, order must be a
    total order), and the group's row count as ``<name>_n``. NULL is a group of its own.

    One global row index minus the group's first position: both come from the indexed rows
    that were written once, and the per-group table is joined null-safe (AQE broadcasts it
    when small and splits a hot group otherwise).
    """
    idx = global_row_index(df, [group, *as_cols(order)], "_k_gpos")
    starts = idx.groupBy(F.col(group).alias("_k_g")).agg(F.count(F.lit(1)).alias(f"{name}_n"),
                                                         F.min("_k_gpos").alias("_k_start"))
    out = idx.join(starts, F.col(group).eqNullSafe(F.col("_k_g")))
    return out.withColumn(name, F.col("_k_gpos") - F.col("_k_start")).drop("_k_gpos", "_k_start", "_k_g")
