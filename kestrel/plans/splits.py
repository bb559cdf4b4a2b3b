"""Sort, limit, top-k, sampling and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.ordering import chunk_ids, percent_range
from ..operators.split import (date_range_split, hash_split, kfold, mod_split, random_split, sample_n, shuffle_rows,
                               split_counts, stratified_split, time_split)
from ..session import table
from .registry import query
from .relational import md5_bucket_sql

HASH_PARTS = [("train", 8), ("valid", 1), ("test", 1)]
_PART_SQL = (f"CASE WHEN {md5_bucket_sql('o_orderkey', 10)} < 8 THEN 'train' "
             f"WHEN {md5_bucket_sql('o_orderkey', 10)} = 8 THEN 'valid' ELSE 'test' END")


@query("sort_values", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort_values_q(spark, sf):
    """L3: full sort (range-partitioned shuffle, then per-partition sort)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), "o_orderkey")


@query("limit_ordered", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""")
def limit_ordered_q(spark, sf):
    """First n rows of an explicit order (TakeOrderedAndProject)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return o.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(100)


@query("top_pairs", """
SELECT l_partkey, l_suppkey, count(*) AS cnt FROM lineitem GROUP BY 1, 2
ORDER BY cnt DESC, l_partkey, l_suppkey LIMIT 100""")
def top_pairs_q(spark, sf):
    """Top-100 most frequent (part, supplier) pairs."""
    li = table(spark, sf, "lineitem")
    agg = li.groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("cnt"))
    return agg.orderBy(F.col("cnt").desc(), "l_partkey", "l_suppkey").limit(100)


@query("sample_one", "SELECT * FROM orders ORDER BY md5('7|' || o_orderkey), o_orderkey LIMIT 1")
def sample_one_q(spark, sf):
    """One random row (seeded)."""
    return sample_n(table(spark, sf, "orders"), 1, seed=7, key=["o_orderkey"])


@query("sample_n", "SELECT * FROM orders ORDER BY md5('200|' || o_orderkey), o_orderkey LIMIT 200")
def sample_n_q(spark, sf):
    """200 random rows (seeded)."""
    return sample_n(table(spark, sf, "orders"), 200, seed=200, key=["o_orderkey"])


@query("random_split_counts", """
SELECT count(*) AS n, CASE WHEN u < 0.6 THEN 'train' WHEN u < 0.8 THEN 'valid' ELSE 'test' END AS part
FROM (SELECT CAST('0x' || substr(md5('200|' || o_orderkey), 1, 8) AS BIGINT) / 4294967296.0 AS u FROM orders) GROUP BY 2""")
def random_split_counts_q(spark, sf):
    """Seeded random 60/20/20 split; part sizes."""
    parts = random_split(table(spark, sf, "orders"), [0.6, 0.2, 0.2], seed=200, key=["o_orderkey"])
    out = None
    for name, p in zip(("train", "valid", "test"), parts):
        c = p.agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit(name))
        out = c if out is None else out.unionByName(c)
    return out


@query("mod_split", "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'test' ELSE 'train' END AS part FROM customer")
def mod_split_q(spark, sf):
    """MOD(key, 5) = 0 is test (20%), else train."""
    return mod_split(table(spark, sf, "customer").select("c_custkey"), "c_custkey")


@query("hash_split_counts", f"SELECT part, count(*) AS n FROM (SELECT {_PART_SQL} AS part FROM orders) GROUP BY part")
def hash_split_counts_q(spark, sf):
    """Stable 80/10/10 hash split; rows per part."""
    o = hash_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", HASH_PARTS)
    return o.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("hash_split_rows", f"SELECT o_orderkey, {_PART_SQL} AS part FROM orders")
def hash_split_rows_q(spark, sf):
    """Split membership of every row."""
    return hash_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", HASH_PARTS)


@query("split_conservation", f"""
SELECT count(*) FILTER (WHERE part = 'test') AS n_test, count(*) FILTER (WHERE part = 'train') AS n_train,
       count(*) FILTER (WHERE part = 'valid') AS n_valid, count(*) AS n_total,
       count(*) FILTER (WHERE part IN ('test', 'train', 'valid')) = count(*) AS conserved
FROM (SELECT {_PART_SQL} AS part FROM orders)""")
def split_conservation_q(spark, sf):
    """Part counts summed against the input in one aggregate."""
    o = hash_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", HASH_PARTS)
    return split_counts(o)


@query("stratified_split", """
SELECT doc_id, quality, CASE WHEN pos < floor(nc * 0.7) THEN 'train'
                             WHEN pos < floor(nc * 0.7) + floor(nc * 0.15) THEN 'valid' ELSE 'test' END AS part
FROM (SELECT doc_id, quality, count(*) OVER (PARTITION BY quality) AS nc,
             row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR) || '-42'), doc_id) - 1 AS pos
      FROM labels)""")
def stratified_split_q(spark, sf):
    """Exact 70/15/15 per class, seeded; rows conserved."""
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    return stratified_split(lab, "quality", "doc_id", [("train", 0.7), ("valid", 0.15), ("test", 0.15)], seed=42)


@query("hash_shuffle", "SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR) || '-7') AS shuffle_key FROM orders")
def hash_shuffle_q(spark, sf):
    """Reproducible shuffle by a seeded hash."""
    return shuffle_rows(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", seed=7)


@query("percent_range_split", """
SELECT doc_id, lang FROM (
  SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS pos, count(*) OVER () AS n FROM documents)
WHERE pos >= floor(n * CAST(10.0 AS DOUBLE) / 100.0) AND pos < floor(n * CAST(12.0 AS DOUBLE) / 100.0)""")
def percent_range_split_q(spark, sf):
    """Rows [10%, 12%) of the id order (TF-style percent slicing)."""
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return percent_range(d, ["doc_id"], 10, 12)


_CUT = "2024-01-21 00:00:00"


@query("time_split_inclusive", f"""
SELECT event_id, 'train' AS part FROM events WHERE ts <= TIMESTAMP '{_CUT}'
UNION ALL SELECT event_id, 'test' AS part FROM events WHERE ts >= TIMESTAMP '{_CUT}'""")
def time_split_inclusive_q(spark, sf):
    """Both ends inclusive, a row at the cut is in both parts."""
    return time_split(table(spark, sf, "events").select("event_id", "ts"), "ts", _CUT).select("event_id", "part")


@query("date_range_split", """
SELECT o_orderkey, 'train' AS part FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1999-12-31'
UNION ALL
SELECT o_orderkey, 'test' AS part FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1999-12-31' AND DATE '2001-12-31'""")
def date_range_split_q(spark, sf):
    """Two date windows sharing a boundary day (the end day covered whole)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return date_range_split(o, "o_orderdate", [("train", "1995-01-01", "1999-12-31"),
                                               ("test", "1999-12-31", "2001-12-31")]).select("o_orderkey", "part")


@query("kfold_assign", f"SELECT o_orderkey, CAST({md5_bucket_sql('o_orderkey', 10)} AS INTEGER) AS fold FROM orders")
def kfold_assign_q(spark, sf):
    """10 folds from a stable key hash."""
    return kfold(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 10)


@query("chunk_ids", """
SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 200) AS BIGINT) AS chunk_id FROM orders""")
def chunk_ids_q(spark, sf):
    """Fixed-size chunks of 200 rows in key order."""
    return chunk_ids(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 200)
