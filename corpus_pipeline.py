"""From raw documents to packed training sequences, in five stages.

Each stage works on all that its predecessor kept; ``run`` writes every stage's result as
Parquet in the shared scratch folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import toxicity
from kestrel.llm.common import load, store
from kestrel.llm.exactdup import exact_groups
from kestrel.llm.mixing import mix
from kestrel.llm.neardup import near_duplicates
from kestrel.llm.packing import pack_documents

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def clean_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject (score below 0.5).

    Every row is scored by its own text (null: empty); null and repeated ids, repeated rows and
    extra columns pass through unchanged.
    """
    return toxicity.keep_clean(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")))


def _only(docs: DataFrame, found: DataFrame, text: Column) -> DataFrame:
    """Rows of ``docs`` whose id and hash of ``text`` are among ``found`` (two columns, any names)."""
    kept = found.toDF("_kestrel_id", "_kestrel_hash").distinct()
    marked = docs.withColumn("_kestrel_of", F.sha2(text.cast("binary"), 256))
    return marked.join(kept, docs["doc_id"].eqNullSafe(kept["_kestrel_id"])
                       & (F.col("_kestrel_of") == F.col("_kestrel_hash")), "left_semi").drop("_kestrel_of")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (after lower-casing A-Z; null: empty) the document with the largest id.

    Rows with the same id and equal texts stay together; rows of one id with different texts are
    documents of their own; a null id is the smallest. Extra columns pass through.
    """
    found = exact_groups(docs).where("kept").select("doc_id", "text_sha256")
    return _only(docs, found, F.translate(F.coalesce(docs["text"], F.lit("")), UPPER, LOWER))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component (five-word shingles, 80 % alike): the smallest id.

    A document is a row's id and text together, told apart by a 64-bit hash of both, so rows of one
    id, or without an id, stay or go by their own texts: of a component the rows with its smallest id
    (null only if it has no other) and one of their texts stay. Texts without words (null, empty,
    blank) are like nothing and stay. Extra columns pass through.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    sha = F.sha2(text.cast("binary"), 256)
    own = F.xxhash64(docs["doc_id"].isNull(), docs["doc_id"], sha)
    found = near_duplicates(docs.select(own.alias("doc_id"), text.alias("text"))).select(
        F.col("doc_id").alias("own"), F.col("component_id").alias("component")).distinct()
    pairs = docs.select(own.alias("own"), docs["doc_id"].alias("id"), sha.alias("sha")).distinct()
    kept = found.join(pairs, "own").groupBy("component").agg(
        F.min_by(F.struct("id", "sha"), F.struct(F.col("id").isNull(), "id", "sha")).alias("k"))
    return _only(docs, kept.select("k.id", "k.sha"), text)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the one at a source's cut if half or more is taken.

    The mix counts words: a document without any (null, empty or blank text) takes nothing of a
    source's budget and is kept once. Rows are told apart by id, source and text, nulls among them;
    extra columns pass through, whatever their names.
    """
    taken = (mix(docs).groupBy(F.col("doc_id").alias("_kestrel_id"), F.col("source").alias("_kestrel_source"),
                               F.col("text_hash").alias("_kestrel_hash"))
             .agg(F.coalesce(F.try_divide(F.sum("taken"), F.sum("size")), F.lit(1.0)).alias("_kestrel_epochs")))
    copies = F.floor(F.col("_kestrel_epochs") + 0.5).cast("int")
    return (docs.join(taken, docs["doc_id"].eqNullSafe(taken["_kestrel_id"])
                      & docs["source"].eqNullSafe(taken["_kestrel_source"])
                      & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == taken["_kestrel_hash"]))
            .where(copies > 0).withColumn("_kestrel_copy", F.explode(F.sequence(F.lit(1), copies))).select(
                *[docs[c] for c in docs.columns]))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens: one row per piece.

    Null texts are empty documents (their end token only); every row, repeated ones too, is packed;
    extra columns are left out.
    """
    return pack_documents(docs)


STAGES = [("toxicity", clean_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage), ("mix", mix_stage),
          ("packing", pack_stage)]

#: A learned stage has no SQL; tests/llm/test_pipeline.py states the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
