"""Joins, set operations and aggregations (J2-J10, U1-U5, A2-A20, R5, R6) on the
driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import trunc_ntz
from ..functions.numeric import stable_bucket
from ..operators.aggregate import (distinct_pairs, distinct_sorted, flag_rate, group_sums, mean_abs, min_max,
                                   mode_value, null_share, nunique_all, period_rate, score_stats, value_counts)
from ..operators.joins import anti_rest, enrich, keyed_left_join, natural_join, suffix_join, union_parts
from ..operators.reshape import count_vector, crosstab, vocabulary
from ..session import table
from .registry import query


def md5_bucket_sql(expr: str, n: int) -> str:
    """DuckDB twin of ``stable_bucket``: first 8 hex digits of md5, mod n."""
    return f"(CAST(('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8)) AS BIGINT) % {n})"


# ---------------------------------------------------------------- joins

@query("profile_join", """
SELECT c.c_custkey, c.c_nationkey, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def profile_join_q(spark, sf):
    """Equi inner join on a named key."""
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return c.join(n, "c_nationkey").select("c_custkey", "c_nationkey", "n_name")


@query("natural_join", """
SELECT n.n_regionkey, n.n_nationkey, n.n_name, r.r_name
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")
def natural_join_q(spark, sf):
    """Natural join on the columns both frames share (after mapping the key name)."""
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return natural_join(n, r)


@query("keyed_left_join", """
SELECT o.o_custkey, o.o_orderkey, c.c_mktsegment, c.c_acctbal
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def keyed_left_join_q(spark, sf):
    """Attach new columns by key."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal")
    return keyed_left_join(o, c, "o_custkey")


@query("suffix_join", """
SELECT l.doc_id, l.quality, l.toxic, p.quality AS quality_pred, p.toxic AS toxic_pred
FROM labels l JOIN (SELECT doc_id, CAST(n_chars > 2000 AS INTEGER) AS quality,
                           CAST(lang <> 'en' AS INTEGER) AS toxic FROM documents) p ON l.doc_id = p.doc_id""")
def suffix_join_q(spark, sf):
    """Join truth to predictions, overlapping columns suffixed '_pred'."""
    lab = table(spark, sf, "labels")
    d = table(spark, sf, "documents")
    pred = d.select("doc_id", (F.col("n_chars") > 2000).cast("int").alias("quality"),
                    (F.col("lang") != "en").cast("int").alias("toxic"))
    return suffix_join(lab, pred, "doc_id", "_pred")


@query("dim_enrich", """
WITH artists AS (SELECT DISTINCT p_brand FROM part),
cand AS (SELECT p_brand, p_partkey, p_name FROM part),
first AS (SELECT p_brand, min(p_partkey) AS mbid FROM cand GROUP BY p_brand)
SELECT a.p_brand, f.mbid, t.tag
FROM artists a LEFT JOIN first f ON a.p_brand = f.p_brand
LEFT JOIN (SELECT c.p_partkey, unnest(string_split(c.p_name, ' ')) AS tag FROM cand c) t ON t.p_partkey = f.mbid""")
def dim_enrich_q(spark, sf):
    """Every artist looked up in a candidate dimension; first match (smallest id)
    wins, its tag list is exploded; no match keeps the artist with NULL tag."""
    part = table(spark, sf, "part")
    artists = part.select("p_brand").distinct()
    cand = part.select("p_brand", F.col("p_partkey").alias("mbid"), F.split("p_name", " ").alias("tags"))
    return enrich(artists, cand, "p_brand", "mbid", "tags")


_SAMPLE_SQL = f"(SELECT * FROM orders WHERE {md5_bucket_sql('o_orderkey', 10)} < 8)"


@query("anti_join_rest", f"""
SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {_SAMPLE_SQL})""")
def anti_join_rest_q(spark, sf):
    """An 80% hash sample, and the rest as a left-anti join by key."""
    o = table(spark, sf, "orders")
    sample = o.filter(stable_bucket("o_orderkey", 10) < 8)
    return anti_rest(o, sample, "o_orderkey")


# ---------------------------------------------------------------- set operations

@query("union_parts", "SELECT o_orderkey, o_orderstatus AS part FROM orders")
def union_parts_q(spark, sf):
    """Parts by status concatenated back (UNION ALL by name)."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("part"))
    known = vocabulary(o, "part")
    parts = [o.filter(F.col("part") == s) for s in known] + [o.filter(F.col("part").isNull())]
    return union_parts(parts)


@query("union_missing_cols", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 5 <> 0
UNION ALL BY NAME
SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 5 = 0""")
def union_missing_cols_q(spark, sf):
    """Train keeps the target, test has it dropped; absent column becomes NULL."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    train = o.filter(F.col("o_orderkey") % 5 != 0)
    test = o.filter(F.col("o_orderkey") % 5 == 0).drop("o_totalprice")
    return union_parts([train, test], allow_missing=True)


# ---------------------------------------------------------------- aggregations

@query("value_counts", "SELECT p_brand, count(*) AS count FROM part GROUP BY p_brand")
def value_counts_q(spark, sf):
    """A2: value counts."""
    return value_counts(table(spark, sf, "part"), "p_brand")


@query("value_shares", """
SELECT o_orderstatus, round(count(*) / sum(count(*)) OVER (), 9) AS share FROM orders GROUP BY o_orderstatus""")
def value_shares_q(spark, sf):
    """A3: normalised value counts."""
    vc = value_counts(table(spark, sf, "orders"), "o_orderstatus", normalize=True)
    return vc.select("o_orderstatus", F.round("share", 9).alias("share"))


@query("group_sum", """
SELECT c.c_mktsegment, o.o_orderstatus, round(sum(o.o_totalprice), 2) AS total
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2""")
def group_sum_q(spark, sf):
    """A4: sum per one and two keys over a join."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return group_sums(j, ["c_mktsegment", "o_orderstatus"], {"total": "o_totalprice"}) \
        .withColumn("total", F.round("total", 2))


@query("group_multi_sum", """
SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS DOUBLE) AS sum_qty,
       round(sum(l_extendedprice), 2) AS sum_price,
       round(sum(l_extendedprice * (1 - l_discount)), 4) AS sum_disc_price, count(*) AS n
FROM lineitem GROUP BY 1, 2""")
def group_multi_sum_q(spark, sf):
    """A5: several sums per group in one aggregate."""
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"),
        F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("sum_disc_price"),
        F.count(F.lit(1)).alias("n"))


@query("group_avg", "SELECT o_orderpriority, round(avg(o_totalprice), 9) AS avg_price FROM orders GROUP BY 1")
def group_avg_q(spark, sf):
    """Mean per group."""
    out = group_sums(table(spark, sf, "orders"), "o_orderpriority", {"avg_price": "o_totalprice"}, how="avg")
    return out.withColumn("avg_price", F.round("avg_price", 9))


@query("avg_by_dow", """
SELECT CAST(dayofweek(l_shipdate) + 1 AS INTEGER) AS dow, round(avg(l_extendedprice), 9) AS avg_price
FROM lineitem GROUP BY 1""")
def avg_by_dow_q(spark, sf):
    """Mean by day of week (1 = Sunday)."""
    li = table(spark, sf, "lineitem")
    return li.groupBy(F.dayofweek("l_shipdate").alias("dow")).agg(
        F.round(F.avg("l_extendedprice"), 9).alias("avg_price"))


@query("avg_by_year_dow", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(dayofweek(l_shipdate) + 1 AS INTEGER) AS dow,
       round(avg(l_extendedprice), 9) AS avg_price FROM lineitem GROUP BY 1, 2""")
def avg_by_year_dow_q(spark, sf):
    """Mean by year x day of week."""
    li = table(spark, sf, "lineitem")
    return li.groupBy(F.year("l_shipdate").alias("year"), F.dayofweek("l_shipdate").alias("dow")).agg(
        F.round(F.avg("l_extendedprice"), 9).alias("avg_price"))


@query("flag_rate_by_bucket", """
SELECT LEAST(l_quantity, 40.0) AS bucket, CAST(sum(CAST(l_returnflag = 'R' AS BIGINT)) AS BIGINT) AS n_flag,
       count(*) AS n, round(avg(CAST(l_returnflag = 'R' AS DOUBLE)), 9) AS rate
FROM lineitem GROUP BY 1""")
def flag_rate_by_bucket_q(spark, sf):
    """Bad rate (sum, count, mean of a flag) per bucket."""
    li = table(spark, sf, "lineitem").select(F.least("l_quantity", F.lit(40.0)).alias("bucket"),
                                             (F.col("l_returnflag") == "R").alias("flag"))
    return flag_rate(li, "bucket", "flag").withColumn("rate", F.round("rate", 9))


@query("quarterly_flag_rate", """
WITH q AS (SELECT CAST(last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS DATE) AS quarter_end,
                  CAST(o_orderstatus = 'F' AS BIGINT) AS f FROM orders),
agg AS (SELECT quarter_end, CAST(sum(f) AS BIGINT) AS n_flag, count(*) AS n FROM q GROUP BY 1),
spine AS (SELECT CAST(last_day(unnest(generate_series(CAST(min(quarter_end) AS TIMESTAMP),
                                                      CAST(max(quarter_end) AS TIMESTAMP), INTERVAL 3 MONTH))) AS DATE)
                 AS quarter_end FROM q)
SELECT s.quarter_end, COALESCE(a.n_flag, 0) AS n_flag, COALESCE(a.n, 0) AS n
FROM spine s LEFT JOIN agg a ON s.quarter_end = a.quarter_end""")
def quarterly_flag_rate_q(spark, sf):
    """A9 + S15: quarter-end grouped sum/count, empty quarters as zero rows."""
    o = table(spark, sf, "orders").select("o_orderdate", (F.col("o_orderstatus") == "F").alias("flag"))
    return period_rate(o, "o_orderdate", "flag")


@query("distinct_sorted", "SELECT DISTINCT p_type FROM part ORDER BY p_type")
def distinct_sorted_q(spark, sf):
    """A10: distinct values, sorted."""
    return distinct_sorted(table(spark, sf, "part"), "p_type")


@query("count_distinct", "SELECT count(DISTINCT o_custkey) AS n_customers FROM orders")
def count_distinct_q(spark, sf):
    """Exact distinct count."""
    return table(spark, sf, "orders").agg(F.countDistinct("o_custkey").alias("n_customers"))


_PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


@query("nunique_all", " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(DISTINCT {c}) AS nunique FROM part" for c in _PART_COLS))
def nunique_all_q(spark, sf):
    """Distinct count of every column in one aggregate, long form."""
    return nunique_all(table(spark, sf, "part"), _PART_COLS)


@query("distinct_pairs", """
SELECT count(DISTINCT (l_returnflag, l_linestatus)) AS n_pairs FROM lineitem""")
def distinct_pairs_q(spark, sf):
    """Distinct (a, b) tuples."""
    return distinct_pairs(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


_NS_BASE = """(SELECT c.c_custkey, NULLIF(c.c_mktsegment, 'BUILDING') AS c_mktsegment, o.n_late, o.last_order
  FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n_late, max(o_orderdate) AS last_order FROM orders
                             WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY o_custkey) o
  ON c.c_custkey = o.o_custkey)"""
_NS_COLS = ["c_custkey", "c_mktsegment", "n_late", "last_order"]


@query("null_share", " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
    f"count(*) FILTER (WHERE {c} IS NULL) / count(*) AS null_share FROM {_NS_BASE}" for c in _NS_COLS))
def null_share_q(spark, sf):
    """Null count and share of every column of a left-joined table."""
    c = table(spark, sf, "customer")
    late = (table(spark, sf, "orders").filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
            .groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_late"), F.max("o_orderdate").alias("last_order")))
    base = c.join(late, c.c_custkey == late.o_custkey, "left").select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("c_mktsegment"), "n_late", "last_order")
    return null_share(base, _NS_COLS)


@query("mean_abs_by_group", """
SELECT date_trunc('hour', ts) AS hour, round(avg(abs(value)), 9) AS ch1, round(avg(abs(value - 100)), 9) AS ch2
FROM events GROUP BY 1""")
def mean_abs_by_group_q(spark, sf):
    """Per signal window (hour), mean absolute value of each channel."""
    ev = table(spark, sf, "events").select(trunc_ntz("ts", "hour").alias("hour"),
                                           F.col("value").alias("ch1"), (F.col("value") - 100).alias("ch2"))
    out = mean_abs(ev, "hour", ["ch1", "ch2"])
    return out.select("hour", F.round("ch1", 9).alias("ch1"), F.round("ch2", 9).alias("ch2"))


_LI_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("minmax_stats", "SELECT " + ", ".join(
    f"CAST(min({c}) AS DOUBLE) + 0.0 AS {c}_min, CAST(max({c}) AS DOUBLE) + 0.0 AS {c}_max" for c in _LI_NUMBERS)
    + " FROM lineitem")
def minmax_stats_q(spark, sf):
    """min/max of every number in Spark's partial + final aggregate; the stored, chunk-wise
    fit is ``incremental_fit``."""
    return min_max(table(spark, sf, "lineitem"), _LI_NUMBERS)


@query("count_vector", """
SELECT o.o_custkey, """ + ", ".join(f"count(*) FILTER (WHERE p.p_type = '{t}') AS \"cat_{t}\"" for t in (
    "ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")) + """
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY o.o_custkey""")
def count_vector_q(spark, sf):
    """Per customer, count of each product type over a fixed vocabulary, 0 if absent."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey).select("o_custkey", "p_type")
    return count_vector(j, "o_custkey", "p_type", vocabulary(p, "p_type"), "cat_")


@query("score_stats", """
SELECT round(max(value), 6) AS max, round(avg(value), 9) AS mean, round(var_samp(value), 6) AS var FROM events""")
def score_stats_q(spark, sf):
    """Max / mean / sample variance of a score."""
    s = score_stats(table(spark, sf, "events"), "value")
    return s.select(*[F.round(c, 9 if c == "mean" else 6).alias(c) for c in s.columns])


@query("mode_value", """
SELECT l_returnflag, mode FROM (
  SELECT l_returnflag, l_quantity AS mode,
         row_number() OVER (PARTITION BY l_returnflag ORDER BY count(*) DESC, l_quantity) AS rk
  FROM lineitem GROUP BY 1, 2) WHERE rk = 1""")
def mode_value_q(spark, sf):
    """Per-group mode, smallest value wins ties."""
    return mode_value(table(spark, sf, "lineitem"), "l_quantity", by="l_returnflag")


_CT_BASE = "(SELECT l_returnflag, CAST(l_discount > 0.05 AS INTEGER) AS bad FROM lineitem)"


@query("crosstab_counts", f"""
SELECT l_returnflag, count(*) FILTER (WHERE bad = 0) AS "0", count(*) FILTER (WHERE bad = 1) AS "1"
FROM {_CT_BASE} GROUP BY 1""")
def crosstab_counts_q(spark, sf):
    """Cross-count of two columns, zeros for empty cells."""
    base = table(spark, sf, "lineitem").select("l_returnflag", (F.col("l_discount") > 0.05).cast("int").alias("bad"))
    return crosstab(base, "l_returnflag", "bad", [0, 1])


@query("crosstab_margins", f"""
SELECT l_returnflag, "0", "1", "All", round_even(100 * "1" / "All", 1) AS pct_bad FROM (
  SELECT l_returnflag, count(*) FILTER (WHERE bad = 0) AS "0", count(*) FILTER (WHERE bad = 1) AS "1",
         count(*) AS "All" FROM {_CT_BASE} GROUP BY 1)""")
def crosstab_margins_q(spark, sf):
    """Cross-count with 'All' margins (CUBE), percent column (half-even round
    as pandas), margin row removed."""
    base = table(spark, sf, "lineitem").select("l_returnflag", (F.col("l_discount") > 0.05).cast("int").alias("bad"))
    return crosstab(base, "l_returnflag", "bad", [0, 1], margins=True, percent_of=("1", "pct_bad"),
                    drop_margin_row=True)
