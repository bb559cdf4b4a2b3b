"""Feature transformer queries (T1-T9, R9, R10): fit on a train part, apply to rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.features import (WORK_HOUR_EDGES, LabelEncode, MinMax, OneHot, RightClosedBins, Standardize,
                                  class_weight, feature_array)
from ..operators.fitstate import FitState, partial_fit
from ..operators.reshape import align_columns, count_vector, vocabulary
from ..session import scratch_path, table
from .registry import query

_TRAIN_LI = "l_shipdate < TIMESTAMP '2000-01-01'"


def _train_li(li):
    return li.filter(F.col("l_shipdate") < F.lit("2000-01-01").cast("timestamp_ntz"))


@query("minmax_scale", f"""
WITH s AS (SELECT min(l_quantity) AS qmin, max(l_quantity) AS qmax, min(l_extendedprice) AS pmin,
                  max(l_extendedprice) AS pmax FROM lineitem WHERE {_TRAIN_LI})
SELECT l_orderkey, l_linenumber, (l_quantity - qmin) / (qmax - qmin) AS l_quantity,
       (l_extendedprice - pmin) / (pmax - pmin) AS l_extendedprice FROM lineitem, s""")
def minmax_scale_q(spark, sf):
    """Min-max fitted on the train period, applied to every row."""
    li = table(spark, sf, "lineitem")
    mm = MinMax.fit(_train_li(li), ["l_quantity", "l_extendedprice"])
    return mm.transform(li.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"))


@query("standardize", f"""
WITH s AS (SELECT avg(l_quantity) AS qm, stddev_pop(l_quantity) AS qs, avg(l_discount) AS dm,
                  stddev_pop(l_discount) AS ds FROM lineitem WHERE {_TRAIN_LI})
SELECT l_orderkey, l_linenumber, round((l_quantity - qm) / qs, 6) AS l_quantity,
       round((l_discount - dm) / ds, 6) AS l_discount FROM lineitem, s""")
def standardize_q(spark, sf):
    """Standardise with the population sd of the train period."""
    li = table(spark, sf, "lineitem")
    st = Standardize.fit(_train_li(li), ["l_quantity", "l_discount"])
    out = st.transform(li.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"))
    return out.select("l_orderkey", "l_linenumber", F.round("l_quantity", 6).alias("l_quantity"),
                      F.round("l_discount", 6).alias("l_discount"))


@query("label_encode", """
WITH tr AS (SELECT * FROM orders WHERE o_orderkey % 5 <> 0),
vp AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT o_orderpriority AS v FROM tr)),
vs AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT o_orderstatus AS v FROM tr))
SELECT o.o_orderkey, vp.code AS o_orderpriority, vs.code AS o_orderstatus
FROM orders o LEFT JOIN vp ON o.o_orderpriority = vp.v LEFT JOIN vs ON o.o_orderstatus = vs.v
WHERE o.o_orderkey % 5 = 0""")
def label_encode_q(spark, sf):
    """Sorted-order codes fitted on train, reused on test (unseen -> NULL)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    enc = LabelEncode.fit(o.filter(F.col("o_orderkey") % 5 != 0), ["o_orderpriority", "o_orderstatus"])
    return enc.transform(o.filter(F.col("o_orderkey") % 5 == 0))


@query("onehot_vector", """
WITH voc AS (SELECT list(v ORDER BY v) AS vs FROM (SELECT DISTINCT o_orderpriority AS v FROM orders
                                                   WHERE o_orderdate < TIMESTAMP '1998-01-01'))
SELECT o_orderkey, list_transform(vs, lambda v: CAST(COALESCE(o_orderpriority = v, false) AS DOUBLE)) AS o_orderpriority_onehot
FROM orders, voc""")
def onehot_vector_q(spark, sf):
    """One-hot array over the train vocabulary, unseen -> all zeros."""
    o = table(spark, sf, "orders")
    oh = OneHot.fit(o.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")), ["o_orderpriority"])
    return oh.transform(o.select("o_orderkey", "o_orderpriority")).drop("o_orderpriority")


_DUMMIES = [("o_orderpriority", p) for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")]
_DUMMIES += [("o_orderstatus", x) for x in "FOP"]


@query("dummies_wide", "SELECT o_orderkey, " + ", ".join(
    f"coalesce(CAST({c} = '{v}' AS INTEGER), 0) AS \"{c}_{v}\"" for c, v in _DUMMIES) + " FROM orders")
def dummies_wide_q(spark, sf):
    """prefix_value dummy columns over fitted vocabularies."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    return OneHot.fit(o, ["o_orderpriority", "o_orderstatus"]).transform(o, wide=True)


_YR = "CAST(year(o_orderdate) AS VARCHAR)"


@query("align_columns", "SELECT o_orderkey, " + ", ".join(
    f"CAST({_YR} = '{y}' AS INTEGER) AS yr_{y}" for y in range(1995, 1999))
    + " FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'")
def align_columns_q(spark, sf):
    """Test dummies aligned to the train columns (absent -> 0, unseen dropped)."""
    o = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").cast("string").alias("yr"), "o_orderdate")
    train = o.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    test = o.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select("o_orderkey", "yr")
    train_cols = OneHot.fit(train, ["yr"]).wide_columns()
    test_d = OneHot.fit(test, ["yr"]).transform(test, wide=True)
    return align_columns(test_d, ["o_orderkey"] + train_cols)


_BIN_CASE = " ".join(
    f"WHEN x > {lo} {'' if hi == float('inf') else f'AND x <= {hi}'} THEN {i}"
    for i, (lo, hi) in enumerate(zip(WORK_HOUR_EDGES[:-1], WORK_HOUR_EDGES[1:])))
_BIN_LABEL = " ".join(
    f"WHEN x > {lo} {'' if hi == float('inf') else f'AND x <= {hi}'} THEN '({lo}, {'inf' if hi == float('inf') else hi}]'"
    for lo, hi in zip(WORK_HOUR_EDGES[:-1], WORK_HOUR_EDGES[1:]))


@query("bin_right_closed", f"""
SELECT l_orderkey, l_linenumber, CASE {_BIN_CASE} END AS bin_idx, CASE {_BIN_LABEL} END AS bin_label
FROM (SELECT l_orderkey, l_linenumber, l_quantity * 1.2 - 5 AS x FROM lineitem)""")
def bin_right_closed_q(spark, sf):
    """T5: right-closed bins (0,10], ..., (50, inf); values <= 0 get NULL."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") * 1.2 - 5).alias("x"))
    b = RightClosedBins(WORK_HOUR_EDGES)
    return li.select("l_orderkey", "l_linenumber", b.index("x").alias("bin_idx"), b.label("x").alias("bin_label"))


@query("feature_row", """
WITH cnt AS (SELECT o.o_custkey, p.p_type, count(*) AS n FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
             JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2),
v AS (SELECT DISTINCT p_type FROM part), s AS (SELECT DISTINCT c_mktsegment FROM customer),
cv AS (SELECT c.c_custkey, list(CAST(COALESCE(cnt.n, 0) AS DOUBLE) ORDER BY v.p_type) AS counts
       FROM customer c CROSS JOIN v LEFT JOIN cnt ON cnt.o_custkey = c.c_custkey AND cnt.p_type = v.p_type GROUP BY 1),
oh AS (SELECT c.c_custkey, list(CAST(c.c_mktsegment = s.c_mktsegment AS DOUBLE) ORDER BY s.c_mktsegment) AS onehot
       FROM customer c CROSS JOIN s GROUP BY 1)
SELECT c.c_custkey, list_concat([c.c_acctbal], cv.counts, oh.onehot) AS features
FROM customer c JOIN cv ON c.c_custkey = cv.c_custkey JOIN oh ON c.c_custkey = oh.c_custkey""")
def feature_row_q(spark, sf):
    """Continuous + per-user count vector + one-hot assembled into one row."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    p = table(spark, sf, "part").select("p_partkey", "p_type")
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey) \
        .select(F.col("o_custkey").alias("c_custkey"), "p_type")
    vocab = vocabulary(p, "p_type")
    cv = count_vector(j, "c_custkey", "p_type", vocab, "cnt_")
    cnt_cols = [f"cnt_{v}" for v in vocab]
    base = c.join(cv, "c_custkey", "left").fillna(0, subset=cnt_cols)
    oh = OneHot.fit(c, ["c_mktsegment"]).transform(base)
    oh = oh.withColumn("counts", F.array(*[F.col(x).cast("double") for x in cnt_cols]))
    return oh.select("c_custkey", feature_array(["c_acctbal"], ["counts", "c_mktsegment_onehot"]).alias("features"))


@query("class_weight", """
WITH r AS (SELECT sum(CAST(quality = 0 AS BIGINT)) AS n0, sum(CAST(quality = 1 AS BIGINT)) AS n1 FROM labels)
SELECT doc_id, quality, CASE WHEN quality = 1 THEN round(n0 / n1, 2) * 100.0 ELSE 100.0 END AS weight FROM labels, r""")
def class_weight_q(spark, sf):
    """Per-row class weight from the majority : minority ratio."""
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    return class_weight(lab, "quality")


_CHUNK_COLS = ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("incremental_fit", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS n, count(*) - count({c}) AS missing, CAST(min({c}) AS DOUBLE) AS low,
       CAST(max({c}) AS DOUBLE) AS high, round(avg({c}), 9) AS mean, round(stddev_samp({c}), 6) AS std FROM lineitem"""
                                               for c in _CHUNK_COLS))
def incremental_fit_q(spark, sf):
    """A stored fit grown chunk by chunk (one chunk per ship year) without reading old rows
    again; its counts, extremes and moments are those of the whole table."""
    li = table(spark, sf, "lineitem").select(*_CHUNK_COLS, F.year("l_shipdate").alias("year"))
    path = scratch_path(spark, "fit-state")
    for (year,) in li.select("year").distinct().orderBy("year").collect():  # a handful of ship years
        partial_fit(path, li.where(F.col("year").eqNullSafe(F.lit(year))), _CHUNK_COLS, str(year))
    out = FitState.load(spark, path).summary(quantiles=())
    return out.select("column", "n", "missing", "low", "high", F.round("mean", 9).alias("mean"),
                      F.round("std", 6).alias("std"))


@query("incremental_scale", f"""
WITH s AS (SELECT min(l_quantity) AS qmin, max(l_quantity) AS qmax, min(l_extendedprice) AS pmin,
                  max(l_extendedprice) AS pmax FROM lineitem WHERE {_TRAIN_LI})
SELECT l_orderkey, l_linenumber, (l_quantity - qmin) / (qmax - qmin) AS l_quantity,
       (l_extendedprice - pmin) / (pmax - pmin) AS l_extendedprice FROM lineitem, s""")
def incremental_scale_q(spark, sf):
    """Min-max scaling made from the merged states of three parts of the train period."""
    li = table(spark, sf, "lineitem")
    train, cols = _train_li(li), ["l_quantity", "l_extendedprice"]
    parts = [FitState.of(train.where(F.col("l_orderkey") % 3 == k), cols) for k in range(3)]
    return parts[0].merge(*parts[1:]).min_max().transform(li.select("l_orderkey", "l_linenumber", *cols))
