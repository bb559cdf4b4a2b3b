"""Artist-liking flow (§3d) and its building blocks: counts, top-N, semi-join, pivots,
tag counters, presence label and column-name cleaning.

Stand-in for the play log: one "listen" per lineitem row, user = the order's customer,
artist = the part's brand, tag = the part's type (or name).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import tag_normalize
from ..operators.aggregate import group_count, keep_top_n, top_n
from ..operators.project import COLUMN_NAME_REPLACEMENTS, clean_names, label_presence
from ..operators.reshape import melt_long, pivot_counts, pivot_values, tag_counts_long, tag_matrix, vocabulary
from ..session import cut_lineage, table
from .registry import query

TOP_ARTISTS = 10


def sql_clean_name(expr: str) -> str:
    """The same ordered name replacements as ``clean_names``, as nested SQL replace()."""
    out = expr
    for old, new in COLUMN_NAME_REPLACEMENTS:
        o, n = old.replace("'", "''"), new.replace("'", "''")
        out = f"replace({out}, '{o}', '{n}')"
    return out


def listens(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .join(p, li.l_partkey == p.p_partkey)
            .select(F.col("o_custkey").alias("user_id"), F.col("p_brand").alias("artist")))


def artist_liking(spark: SparkSession, sf: str, target: str, n_top: int = TOP_ARTISTS) -> DataFrame:
    """Top-n artists -> per-user play counts (wide) + tag counters -> presence label of
    the ``target`` artist -> cleaned column names.

    The listen join runs once: it is reduced to (user, artist) counts (map-side
    partial aggregation, so a hot artist or user is pre-combined per task), written
    once to the shared checkpoint folder, and that aggregate feeds both the top-n
    ranking (an artist's listens = the sum of its counts) and the per-user pivot.
    """
    pair_counts = cut_lineage(group_count(listens(spark, sf), ["user_id", "artist"]))
    top = (pair_counts.groupBy("artist").agg(F.sum("cnt").alias("n"))
           .orderBy(F.col("n").desc(), F.col("artist")).limit(n_top))
    top_list = [r["artist"] for r in top.collect()]  # n_top rows
    artist_tags = (table(spark, sf, "part")
                   .select(F.col("p_brand").alias("artist"), tag_normalize(F.col("p_type")).alias("tag")).distinct())
    tags = artist_tags.filter(F.col("artist").isin(*top_list))
    tag_vocab = vocabulary(tags, "tag")
    plays = pair_counts.filter(F.col("artist").isin(*top_list))
    wide = pivot_values(plays, "user_id", "artist", "cnt", top_list)
    tag_long = tag_counts_long(plays.filter(F.col("cnt") > 0), tags, "user_id", "artist", "tag")
    tag_wide = pivot_values(tag_long, "user_id", "tag", "n", tag_vocab)
    out = wide.join(tag_wide, "user_id", "left")
    if target not in top_list:
        out = out.withColumn(target, F.lit(None).cast("long"))
    out = label_presence(out, target, "label")
    return clean_names(out)


_LISTEN_SQL = """
listen AS (
  SELECT o.o_custkey AS user_id, p.p_brand AS artist, p.p_type AS p_type
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""

_LISTEN_SUB = """(
  SELECT o.o_custkey AS user_id, p.p_brand AS artist
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""
_TOP_SUB = f"""(
  SELECT artist, row_number() OVER (ORDER BY count(*) DESC, artist) AS rk
  FROM {_LISTEN_SUB} GROUP BY artist ORDER BY count(*) DESC, artist LIMIT {TOP_ARTISTS})"""
_PLAYS_SUB = f"""(
  SELECT user_id, artist, count(*) AS cnt FROM {_LISTEN_SUB}
  WHERE artist IN (SELECT artist FROM {_TOP_SUB}) GROUP BY user_id, artist)"""
_TAGS_SUB = f"""(
  SELECT DISTINCT p_brand AS artist, 'tag_' || replace(lower(p_type), '-', ' ') AS tag
  FROM part WHERE p_brand IN (SELECT artist FROM {_TOP_SUB}))"""

#: The artist whose presence is the label, and the columns of the wide oracles.
TARGET = "Brand#13"
_BRANDS = [f"Brand#{i}" for i in range(1, 26)]
_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
_EVENTS = ["click", "error", "purchase", "signup", "view"]


def py_clean_name(name: str) -> str:
    for old, new in COLUMN_NAME_REPLACEMENTS:
        name = name.replace(old, new)
    return name


def cells_sql(column: str, values, cell: str, names=None) -> str:
    """One conditional aggregate per value (a wide result that a view can hold)."""
    return ", ".join(f"{cell} FILTER (WHERE {column} = '{v}') AS \"{n}\"" for v, n in zip(values, names or values))


_TAGS = ["tag_" + t.lower() for t in _TYPES]

PLAY_COUNTS_PIVOT_SQL = f"""
WITH {_LISTEN_SQL},
pairs AS (SELECT user_id, artist, count(*) AS cnt FROM listen GROUP BY 1, 2),
w AS (SELECT user_id, {cells_sql("artist", [b for b in _BRANDS if b != TARGET], "max(cnt)",
                                 [py_clean_name(b) for b in _BRANDS if b != TARGET])},
             bool_or(artist = '{TARGET}') AS label FROM pairs GROUP BY user_id),
tags AS (SELECT DISTINCT p_brand AS artist, 'tag_' || replace(lower(p_type), '-', ' ') AS tag FROM part),
t AS (SELECT user_id, tag, count(*) AS n FROM pairs JOIN tags USING (artist) GROUP BY 1, 2),
tw AS (SELECT user_id, {cells_sql("tag", _TAGS, "max(n)", [py_clean_name(t) for t in _TAGS])} FROM t GROUP BY user_id)
SELECT w.*, tw.* EXCLUDE (user_id) FROM w LEFT JOIN tw ON w.user_id = tw.user_id
"""


@query("play_counts_pivot", PLAY_COUNTS_PIVOT_SQL)
def play_counts_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """§3d end to end: A1 + L1 + J1 + R1 + R3 + P14 + P5, the top 25 artists."""
    return artist_liking(spark, sf, TARGET, n_top=25)


@query("play_counts_top10", f"""
WITH pl AS (SELECT * FROM {_PLAYS_SUB}), tg AS (SELECT * FROM {_TAGS_SUB}),
cells AS (
  SELECT user_id, {sql_clean_name('artist')} AS "column", cnt AS "value" FROM pl WHERE artist <> '{TARGET}'
  UNION ALL
  SELECT user_id, {sql_clean_name('tag')}, count(*) FROM pl JOIN tg USING (artist) GROUP BY 1, 2),
names AS (SELECT DISTINCT {sql_clean_name('artist')} AS "column" FROM pl WHERE artist <> '{TARGET}'
          UNION SELECT {sql_clean_name('tag')} FROM tg),
users AS (SELECT user_id, bool_or(artist = '{TARGET}') AS label FROM pl GROUP BY 1)
SELECT user_id, label, "column", "value" FROM users CROSS JOIN names LEFT JOIN cells USING (user_id, "column")
""")
def play_counts_top10(spark: SparkSession, sf: str) -> DataFrame:
    """§3d for the top 10 artists, whose names depend on the data: the wide result as long rows."""
    wide = artist_liking(spark, sf, TARGET)
    long = melt_long(wide.drop("label"), "user_id")
    return long.join(wide.select("user_id", "label"), "user_id")


@query("play_counts", """
SELECT user_id, event_type, count(*) AS cnt FROM events GROUP BY user_id, event_type
""")
def play_counts(spark, sf):
    """A1: count per (user, artist) on the event log."""
    return group_count(table(spark, sf, "events"), ["user_id", "event_type"])


@query("top_n_by_count", """
SELECT o_custkey, count(*) AS cnt FROM orders GROUP BY o_custkey
ORDER BY cnt DESC, o_custkey LIMIT 20
""")
def top_n_by_count(spark, sf):
    """L1: top-20 customers by number of orders, key as tie-break."""
    return top_n(table(spark, sf, "orders"), "o_custkey", 20)


@query("top_n_by_sum", """
SELECT l_suppkey, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY l_suppkey
ORDER BY total DESC, l_suppkey LIMIT 10
""")
def top_n_by_sum(spark, sf):
    """L2: top-10 suppliers by summed price."""
    li = table(spark, sf, "lineitem")
    agg = li.groupBy("l_suppkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))
    return agg.orderBy(F.col("total").desc(), F.col("l_suppkey")).limit(10)


@query("top_n_semi_join", """
SELECT * FROM events WHERE user_id IN (
  SELECT user_id FROM events GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 20)
""")
def top_n_semi_join(spark, sf):
    """Keep events of the 20 most active users (IN-subquery as broadcast semi-join)."""
    return keep_top_n(table(spark, sf, "events"), "user_id", 20)


@query("pivot_counts", f"""
SELECT user_id, {cells_sql("event_type", _EVENTS, "max(cnt)")}
FROM (SELECT user_id, event_type, count(*) AS cnt FROM events GROUP BY ALL) GROUP BY user_id
""")
def pivot_counts_q(spark, sf):
    """User x event type counts, absent pairs NULL, vocabulary passed in."""
    ev = table(spark, sf, "events")
    return pivot_counts(ev, "user_id", "event_type", vocabulary(ev, "event_type"))


@query("tag_counts", f"""
WITH {_LISTEN_SQL},
pairs AS (SELECT DISTINCT user_id, artist FROM listen),
tags AS (SELECT DISTINCT p_brand AS artist, 'tag_' || replace(lower(p_type), '-', ' ') AS tag FROM part)
SELECT user_id, {cells_sql("tag", _TAGS, "max(n)")}
FROM (SELECT pr.user_id, t.tag, count(*) AS n FROM pairs pr JOIN tags t ON pr.artist = t.artist GROUP BY ALL)
GROUP BY user_id
""")
def tag_counts_q(spark, sf):
    """Per customer, number of distinct brands bought that carry each type tag."""
    part = table(spark, sf, "part")
    tags = part.select(F.col("p_brand").alias("artist"), tag_normalize(F.col("p_type")).alias("tag")).distinct()
    long = tag_counts_long(listens(spark, sf), tags, "user_id", "artist", "tag")
    return pivot_values(long, "user_id", "tag", "n", vocabulary(tags, "tag"))


@query("tag_matrix", """
WITH t AS (SELECT DISTINCT p_brand, 'tag_' || replace(lower(p_name), '-', ' ') AS "column" FROM part)
SELECT b.p_brand, v."column", t.p_brand IS NOT NULL AS "value"
FROM (SELECT DISTINCT p_brand FROM t) b CROSS JOIN (SELECT DISTINCT "column" FROM t) v LEFT JOIN t
ON t.p_brand = b.p_brand AND t."column" = v."column"
""")
def tag_matrix_q(spark, sf):
    """Brand x name-tag boolean matrix, True where present then False-filled, as long rows
    (its columns depend on the data)."""
    part = table(spark, sf, "part").select("p_brand", tag_normalize(F.col("p_name")).alias("tag"))
    return melt_long(tag_matrix(part, "p_brand", "tag", vocabulary(part, "tag")), "p_brand")


@query("tag_matrix_types", f"""
WITH t AS (SELECT p_brand, 'tag_' || replace(lower(p_type), '-', ' ') AS tag FROM part)
SELECT p_brand, {", ".join(f"bool_or(tag = '{t}') AS \"{t}\"" for t in _TAGS)} FROM t GROUP BY p_brand
""")
def tag_matrix_types_q(spark, sf):
    """Brand x type-tag boolean matrix, wide."""
    part = table(spark, sf, "part").select("p_brand", tag_normalize(F.col("p_type")).alias("tag"))
    return tag_matrix(part, "p_brand", "tag", vocabulary(part, "tag"))


@query("label_presence", f"""
SELECT user_id, {cells_sql("event_type", [e for e in _EVENTS if e != "purchase"], "max(cnt)")},
       bool_or(event_type = 'purchase') AS label
FROM (SELECT user_id, event_type, count(*) AS cnt FROM events GROUP BY ALL) GROUP BY user_id
""")
def label_presence_q(spark, sf):
    """label = user has any 'purchase' event; the source column is dropped."""
    ev = table(spark, sf, "events")
    wide = pivot_counts(ev, "user_id", "event_type", vocabulary(ev, "event_type"))
    return label_presence(wide, "purchase", "label")


@query("clean_column_names", f"""
WITH c AS (SELECT p_brand, {sql_clean_name('p_name')} AS "column", count(*) AS "value" FROM part GROUP BY ALL)
SELECT b.p_brand, v."column", c."value"
FROM (SELECT DISTINCT p_brand FROM c) b CROSS JOIN (SELECT DISTINCT "column" FROM c) v LEFT JOIN c
ON c.p_brand = b.p_brand AND c."column" = v."column"
""")
def clean_column_names_q(spark, sf):
    """P5: pivot brand x part name, rewrite names by the ordered replacement list, show the
    result as long rows (its columns depend on the data)."""
    part = table(spark, sf, "part")
    wide = pivot_counts(part, "p_brand", "p_name", vocabulary(part, "p_name"))
    return melt_long(clean_names(wide), "p_brand")


@query("clean_brand_names", f"""
SELECT p_type, {cells_sql("p_brand", _BRANDS, "max(n)", [py_clean_name(b) for b in _BRANDS])}
FROM (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY ALL) GROUP BY p_type
""")
def clean_brand_names_q(spark, sf):
    """P5: pivot type x brand, then rewrite the wide names."""
    part = table(spark, sf, "part")
    return clean_names(pivot_counts(part, "p_type", "p_brand", vocabulary(part, "p_brand")))
