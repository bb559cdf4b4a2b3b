"""Driver queries of the training-data operators, with their DuckDB statements where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, toxicity
from .common import load
from .dialogue import repair_report
from .exactdup import exact_groups
from .extract import extract_text
from .mixing import mix
from .neardup import near_duplicates
from .negatives import hard_negatives
from .packing import pack_documents
from .quantised import near_vectors
from .tokens import count_tokens
from .topk import top_k
from .warc import round_trip

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn
    return deco


@query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text by overlap resynchronisation."""
    return count_tokens(load(spark, sf_dir, "documents"))


@query("op2_best_fit_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed to sequences of 4096 tokens, with each partition's certificate."""
    return pack_documents(load(spark, sf_dir, "documents"))


LOWER = """translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"""


@query("op3_minhash_near_dedup", rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, p.y FROM r JOIN p ON r.y = p.x)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.y) AS component_id, d.doc_id = min(r.y) AS kept
FROM documents d JOIN r ON r.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles are 85 % alike or more."""
    return near_duplicates(load(spark, sf_dir, "documents"), shingle_words=3, percent=85)


SIZED = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS BIGINT) AS w
  FROM sized GROUP BY source),
cum AS (
  SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS ws,
         coalesce(sum(3 * source_size) OVER byr, 0) AS full_before, coalesce(sum(w) OVER byr, 0) AS w_before
  FROM src WINDOW byr AS (ORDER BY 3 * source_size / w, source NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (
  SELECT max(CAST(total - full_before AS DOUBLE) / CAST(ws - w_before AS DOUBLE)) AS level
  FROM cum WHERE CAST(total - full_before AS DOUBLE) / CAST(ws - w_before AS DOUBLE) * w <= 3 * source_size),
tgt AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), w * coalesce(level, 0)) AS target
  FROM src, lev),
cut AS (
  SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget,
         CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS epochs
  FROM tgt),
run AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k, doc_id ROWS UNBOUNDED PRECEDING) - size AS before
  FROM sized)
"""


@query("op4_mix_sources", SIZED + """
SELECT r.doc_id, r.size, c.source_size, c.target,
       CAST(c.epochs * r.size + greatest(0, least(r.size, c.budget - c.epochs * c.source_size - r.before))
            AS BIGINT) AS taken
FROM run r JOIN cut c ON r.source IS NOT DISTINCT FROM c.source
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document in the mix to target weights 1, 2, 3, repeating by source."""
    return mix(load(spark, sf_dir, "documents")).drop("source", "text_hash")


@query("op8_exact_dedup", """
WITH n AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT *, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
             count(*) OVER (PARTITION BY text_sha256) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents equal after lower-casing A-Z; the largest id stays."""
    return exact_groups(load(spark, sf_dir, "documents"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, by sentences; learned from labels outside of the held-out fifth."""
    docs = load(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")))


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(CAST('0x' || substr(h, {5 * i + 1}, 5) AS BIGINT) // {d} % 32 + 1 "
    "AS BIGINT), 1)" for i in range(8) for d in (32768, 1024, 32, 1))


@query("op6_warc_records", f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM g
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all pages, written to WARC archives and read back."""
    return round_trip(load(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                           "refers_to")


@query("op7_topk_search", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every vector whose id is divisible by 50."""
    return top_k(load(spark, sf_dir, "embeddings"), k=5, every=50)


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text; learned from documents outside of the held-out fifth."""
    return langid.identify_languages(load(spark, sf_dir, "documents"))


@query("op10_html_extraction")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_text(load(spark, sf_dir, "pages"))


@query("op11_conversation_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and digest of every damaged conversation."""
    return repair_report(load(spark, sf_dir, "conversations"))


@query("op12_embedding_near_dedup", """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
r AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, p.y FROM r JOIN p ON r.y = p.x),
n AS (SELECT x, count(*) AS n FROM p GROUP BY x)
SELECT e.vec_id, coalesce(max(n.n), 0) AS n_links, min(r.y) AS component_id, e.vec_id = min(r.y) AS kept
FROM embeddings e JOIN r ON r.x = e.vec_id LEFT JOIN n ON n.x = e.vec_id GROUP BY e.vec_id
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors linked at a cosine of 0.95 or more, and their components."""
    return near_vectors(load(spark, sf_dir, "embeddings"))


@query("op13_hard_negatives", """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, c.vec_id AS c, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.v) = len(c.v)),
p AS (
  SELECT a, c AS p, score, row_number() OVER (PARTITION BY a ORDER BY score DESC, c) AS r FROM s WHERE same),
n AS (
  SELECT p.a, p.p, s.c, p.score AS ps, s.score AS ns,
         row_number() OVER (PARTITION BY p.a, p.p ORDER BY s.score DESC, s.c) AS r
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score WHERE p.r <= 5)
SELECT a AS anchor_id, p AS positive_id, CAST(r AS INTEGER) AS rank, c AS negative_id, ps AS positive_score,
       ns AS negative_score FROM n WHERE r <= 5
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 hardest negatives of each anchor's 5 positives, with some labels wrong by one."""
    table = load(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table.withColumn("label", label))
