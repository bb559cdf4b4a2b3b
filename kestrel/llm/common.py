"""Helpers shared by the training-data operators: stored intermediate tables, Arrow batch
slicing, connected components over a distributed edge list.

Every operator renames the columns it needs to private names first, so extra columns
of the input (also ones called like an output column) never clash.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import scratch_path


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage: a lost executor costs no recomputation of what came before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by ``store`` that nothing reads any more."""
    path = getattr(df, "_stored_at", None)
    if path:
        spark = df.sparkSession
        hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


def text_or_empty(docs: DataFrame, text_col: str) -> Column:
    """The text column; null counts as the empty text."""
    return F.coalesce(docs[text_col].cast("string"), F.lit(""))


def slices(batch, rows: int, text_column: int, max_bytes: int) -> Iterator:
    """Cut an Arrow batch to slices of at most ``rows`` rows and about ``max_bytes`` of text.

    A single row above ``max_bytes`` is a slice of its own.
    """
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(text_column)), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and (i - start >= rows or held + size > max_bytes):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def blocks_of(n_rows: int, rows_per_block: int) -> int:
    """How many blocks hold ``n_rows`` rows (at least one)."""
    return max(1, -(-n_rows // rows_per_block))


def crc_remainder(id_col: Column, modulus: int = 5) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % modulus


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge list: (node, comp) for every node of an edge.

    ``comp`` is one node of the component. Each round maps a node to the least of its
    neighbours and itself and contracts the edges; rounds end when no edge is left. Nodes
    should be hash values, so that the number of rounds grows with the logarithm of the
    longest path. Edges and labels stay distributed; each round is stored.
    """
    pairs = (edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b"))
    pairs = store(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .distinct(), "cc-edges")
    labels = store(pairs.select("a").union(pairs.select("b")).distinct()
                   .select(F.col("a").alias("node"), F.col("a").alias("comp")), "cc-labels")
    while not pairs.isEmpty():
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = store(both.groupBy("a").agg(F.min("b").alias("m"))
                    .select(F.col("a").alias("n"), F.least("a", "m").alias("m")), "cc-low")
        nxt = (pairs.join(low.select(F.col("n").alias("a"), F.col("m").alias("x")), "a")
               .join(low.select(F.col("n").alias("b"), F.col("m").alias("y")), "b")
               .where("x <> y")
               .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        nxt = store(nxt, "cc-edges")
        relabelled = store(labels.join(low, labels["comp"] == low["n"], "left")
                           .select("node", F.coalesce("m", "comp").alias("comp")), "cc-labels")
        for old in (pairs, labels, low):
            discard(old)
        pairs, labels = nxt, relabelled
    discard(pairs)
    return labels


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
