"""Mixing sources to target weights by hash-random order and distributed prefix sums.

Every document gets a hash-random key. Inside each source, equal ranges of the key space
(as many as the source needs) are the sorted partitions: range totals are summed along the
ranges, sizes inside a range along the key, and both together give each document's prefix
sum without ever holding a source in one task. A source's budget is then cut exactly:
whole epochs first, then the documents up to the budget in key order, the one at the cut
in part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.ordering import global_row_index

from .common import store, text_or_empty

#: A word is a run of characters other than space, tab, newline, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
#: Documents in a key range.
ROWS_PER_RANGE = 2_048


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def fill_level(sources: DataFrame, max_epochs: int) -> tuple[float, int]:
    """(level, total): a source's target is min(max_epochs * size, weight * level).

    Raises the level until what capped sources cannot take is shared by weight among the
    others. Each round is one aggregate over the source table; a round caps at least one
    more source or is the last.
    """
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return 0.0, 0
    level = total / weight
    while True:
        cap = F.col("source_size") * max_epochs
        capped = F.col("weight") * F.lit(level) >= cap
        full, rest = sources.agg(F.sum(F.when(capped, cap)), F.sum(F.when(~capped, F.col("weight")))).first()
        if not rest:
            return level, total
        higher = (total - (full or 0)) / rest
        if higher <= level:
            return level, total
        level = higher


def source_targets(sizes: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """One row per source (null last): source, source_rank, n_docs, source_size, weight, target."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    ranked = global_row_index(totals, [F.col("source").asc_nulls_last()], "source_rank")
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = store(ranked.withColumn("weight", F.element_at(cycle, (F.col("source_rank") % len(weights) + 1)
                                                            .cast("int"))), "mix-sources")
    level, _ = fill_level(ranked, max_epochs)
    target = F.least(F.col("source_size") * F.lit(float(max_epochs)), F.col("weight") * F.lit(float(level)))
    return ranked.withColumn("target", target)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """Words that the mix takes of each document: (doc_id, source, text_hash, size, source_size, target, taken).

    ``weights`` repeat along the sources in code point order, a null source last. The mix is as
    large as the input; no source takes more than ``max_epochs`` times its size, and what it
    cannot take goes to the others by weight. A source's taken words add up to its target
    rounded to a whole word. Reruns agree: keys are hashes of the ids. Rows with equal ids are
    ordered by size and text hash. Null text: size 0. Null ids share a key. An empty table
    gives an empty result, sources without words a target of 0. Extra columns are ignored.
    """
    text = text_or_empty(docs, text_col)
    sizes = store(docs.select(
        docs[id_col].cast("long").alias("doc_id"), docs[source_col].cast("string").alias("source"),
        n_words(text).alias("size"), F.md5(F.coalesce(docs[id_col].cast("string"), F.lit(""))
                                           .cast("binary")).alias("key"),
        F.xxhash64(text).alias("text_hash")), "mix-sizes")
    sources = store(source_targets(sizes, weights, max_epochs), "mix-targets")
    budget = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target + 0.5) div source_size")).otherwise(0)
    part = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(1 << 32)
    keyed = (sizes.withColumnRenamed("source", "own")
             .join(sources.withColumn("epochs", epochs.cast("long"))
                   .withColumn("rest", budget - F.col("epochs") * F.col("source_size")),
                   F.col("own").eqNullSafe(F.col("source")))
             .withColumn("key_range", F.floor(part * F.ceil(F.col("n_docs") / ROWS_PER_RANGE)).cast("long")))
    inside = Window.partitionBy("source_rank", "key_range").orderBy("key", "doc_id", "size", "text_hash")
    along = Window.partitionBy("source_rank").orderBy("key_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (keyed.groupBy("source_rank", "key_range").agg(F.sum("size").alias("range_size"))
              .select("source_rank", "key_range", F.coalesce(F.sum("range_size").over(along), F.lit(0)).alias("before")))
    placed = (keyed.withColumn("inner", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
                               - F.col("size"))
              .join(ranges, ["source_rank", "key_range"]))
    left = F.col("rest") - F.col("before") - F.col("inner")
    taken = F.col("epochs") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))
    return placed.select("doc_id", "source", "text_hash", "size", "source_size", "target",
                         taken.cast("long").alias("taken"))
