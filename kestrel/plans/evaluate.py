"""Profiling and metric queries.

Scored rows: ``labels`` joined to ``documents`` with a deterministic score
s = n_chars / (n_chars + 2000) standing in for a model's probability.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arrays import argmax_index
from ..operators.metrics import (best_f1_threshold, best_trial, binary_metrics, compare_scores, confusion_matrix,
                                 exact_match_accuracy, log_loss, mae_mse, mape, roc_auc, trial_table)
from ..operators.profile import (column_summary, compare_splits, corr_matrix, data_summary, describe,
                                 describe_categorical, histogram, moments, shape)
from ..session import table
from .registry import query

_SCORED_SQL = """(SELECT l.doc_id, l.quality AS label, d.n_chars / (d.n_chars + 2000.0) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def scored(spark, sf):
    lab = table(spark, sf, "labels")
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    return lab.join(d, "doc_id").select("doc_id", F.col("quality").alias("label"),
                                        (F.col("n_chars") / (F.col("n_chars") + 2000.0)).alias("score"))


def _round_all(df, digits=6, nine=()):
    """Round double outputs (both engines sum in different orders). Means and ratios of
    finite-decimal data are exact decimals with up to ~9 places, so those (``nine``)
    are rounded at 9 places, clear of the 6th-place ties the engines break differently."""
    return df.select(*[F.round(c, 9 if c in nine else digits).alias(c) if t == "double" else F.col(c)
                       for c, t in df.dtypes])


# ---------------------------------------------------------------- profiling

@query("shape", "SELECT count(*) AS n_rows, CAST(11 AS INTEGER) AS n_cols FROM lineitem")
def shape_q(spark, sf):
    """Rows and columns."""
    return shape(table(spark, sf, "lineitem"))


_DESC_COLS = [  # every number of lineitem
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_sql(cols, src):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 9) AS mean, round(stddev_samp({c}), 6) AS std, "
        f"round(min({c}), 9) AS min, round(quantile_cont({c}, 0.25), 9) AS p25, round(quantile_cont({c}, 0.5), 9) AS p50, "
        f"round(quantile_cont({c}, 0.75), 9) AS p75, round(max({c}), 9) AS max FROM {src}" for c in cols)


@query("describe_long", _describe_sql(_DESC_COLS, "lineitem"))
def describe_long_q(spark, sf):
    """Count, mean, sd, min, exact quartiles, max per column, one row each."""
    return _round_all(describe(table(spark, sf, "lineitem"), _DESC_COLS), 9).withColumn("std", F.round("std", 6))


@query("describe_categorical", " UNION ALL ".join(
    f"SELECT '{c}' AS column, (SELECT count({c}) FROM orders) AS count, (SELECT count(DISTINCT {c}) FROM orders) AS unique, "
    f"top, freq FROM (SELECT {c} AS top, count(*) AS freq FROM orders WHERE {c} IS NOT NULL GROUP BY 1 "
    f"ORDER BY freq DESC, top LIMIT 1)" for c in ["o_orderstatus", "o_orderpriority"]))
def describe_categorical_q(spark, sf):
    """Count / unique / top / freq per string column."""
    return describe_categorical(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"])


_NS_BASE = """(SELECT c.c_custkey, NULLIF(c.c_mktsegment, 'BUILDING') AS c_mktsegment, o.n_late, o.last_order
  FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n_late, max(o_orderdate) AS last_order FROM orders
                             WHERE o_orderdate >= TIMESTAMP '2001-01-01' GROUP BY o_custkey) o
  ON c.c_custkey = o.o_custkey)"""
_NS_TYPES = {"c_custkey": "bigint", "c_mktsegment": "string", "n_late": "bigint", "last_order": "timestamp_ntz"}


def _ns_base(spark, sf):
    c = table(spark, sf, "customer")
    late = (table(spark, sf, "orders").filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))
            .groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_late"), F.max("o_orderdate").alias("last_order")))
    return c.join(late, c.c_custkey == late.o_custkey, "left").select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("c_mktsegment"), "n_late", "last_order")


@query("column_summary", " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(DISTINCT {c}) AS unique, '{t}' AS dtype, "
    f"round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 9) AS missing_pct FROM {_NS_BASE}"
    for c, t in _NS_TYPES.items()))
def column_summary_q(spark, sf):
    """Unique count, type and missing % of every column."""
    return _round_all(column_summary(_ns_base(spark, sf)), nine=("missing_pct",))


_DS_COLS = _DESC_COLS


@query("data_summary", " UNION ALL ".join(
    f"SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 9) AS mean, round(stddev_samp({c}), 6) AS std, "
    f"round(min({c}), 9) AS min, round(quantile_cont({c}, 0.25), 9) AS p25, round(quantile_cont({c}, 0.5), 9) AS p50, "
    f"round(quantile_cont({c}, 0.75), 9) AS p75, round(max({c}), 9) AS max, "
    f"count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) FILTER (WHERE {c} = 0) AS zeros, "
    f"count(DISTINCT {c}) AS unique FROM lineitem" for c in _DS_COLS))
def data_summary_q(spark, sf):
    """E5: describe + NULL, zero and distinct counts."""
    return _round_all(data_summary(table(spark, sf, "lineitem"), _DS_COLS), 9).withColumn("std", F.round("std", 6))


_CORR_COLS = _DESC_COLS


@query("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for a in _CORR_COLS for b in _CORR_COLS))
def corr_matrix_q(spark, sf):
    """Pearson correlation of every pair, long form."""
    return _round_all(corr_matrix(table(spark, sf, "lineitem"), _CORR_COLS))


def _hist_sql(col, bins, src, by=None):
    keys = f"{by}, " if by else ""
    spine_src = f"(SELECT DISTINCT {by} FROM {src})" if by else "(SELECT 1 AS _one)"
    join_keys = f"s.{by} = c.{by} AND " if by else ""
    return f"""
WITH st AS (SELECT min({col}) AS lo, max({col}) AS hi FROM {src}),
w AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / {bins} ELSE 1.0 END AS width FROM st),
c AS (SELECT {keys}CAST(least(floor(({col} - lo) / width), {bins - 1}) AS INTEGER) AS bin, count(*) AS cnt
      FROM {src}, w WHERE {col} IS NOT NULL GROUP BY ALL),
s AS (SELECT {keys}CAST(g.bin AS INTEGER) AS bin FROM {spine_src} CROSS JOIN generate_series(0, {bins - 1}) g(bin))
SELECT {('s.' + by + ', ') if by else ''}s.bin, round(lo + s.bin * width, 6) AS left, round(lo + (s.bin + 1) * width, 6) AS right,
       COALESCE(c.cnt, 0) AS count
FROM s CROSS JOIN w LEFT JOIN c ON {join_keys}s.bin = c.bin"""


@query("histogram_bins", _hist_sql("l_extendedprice", 20, "lineitem"))
def histogram_bins_q(spark, sf):
    """20 equal-width bins over [min, max], top edge in the last bin."""
    return _round_all(histogram(table(spark, sf, "lineitem"), "l_extendedprice", 20))


@query("histogram_by_class", _hist_sql("o_totalprice", 10, "orders", by="o_orderstatus"))
def histogram_by_class_q(spark, sf):
    """Histogram per class over shared bin edges."""
    return _round_all(histogram(table(spark, sf, "orders"), "o_totalprice", 10, by="o_orderstatus"))


@query("count_by_class", "SELECT o_orderpriority, o_orderstatus, count(*) AS count FROM orders GROUP BY 1, 2")
def count_by_class_q(spark, sf):
    """Counts by category x class ('count plot with hue')."""
    o = table(spark, sf, "orders")
    return o.groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("count"))


@query("count_by_year", "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS count FROM orders GROUP BY 1")
def count_by_year_q(spark, sf):
    """Count per year of a date column."""
    o = table(spark, sf, "orders")
    return o.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("count"))


@query("moments", """
WITH m AS (SELECT avg(l_extendedprice) AS mu FROM lineitem),
c AS (SELECT count(*) AS n, min(l_extendedprice) AS mn, max(l_extendedprice) AS mx, avg(l_extendedprice) AS mean,
             var_samp(l_extendedprice) AS variance, avg(pow(l_extendedprice - mu, 2)) AS m2,
             avg(pow(l_extendedprice - mu, 3)) AS m3, avg(pow(l_extendedprice - mu, 4)) AS m4 FROM lineitem, m)
SELECT n, round(mn, 6) AS min, round(mx, 6) AS max, round(mean, 9) AS mean, round(variance, 6) AS variance,
       round(m3 / pow(m2, 1.5), 6) AS skewness, round(m4 / (m2 * m2) - 3, 6) AS kurtosis FROM c""")
def moments_q(spark, sf):
    """N, min/max, mean, variance, skewness, excess kurtosis."""
    return _round_all(moments(table(spark, sf, "lineitem"), "l_extendedprice"), nine=("mean",))


@query("length_by_class", """
SELECT l.quality, count(*) AS n, CAST(min(length(d.text)) AS INTEGER) AS min_len,
       CAST(max(length(d.text)) AS INTEGER) AS max_len,
       round(avg(length(d.text)), 9) AS mean_len
FROM labels l JOIN documents d ON l.doc_id = d.doc_id GROUP BY 1""")
def length_by_class_q(spark, sf):
    """Text length statistics by label (mask, not position)."""
    lab = table(spark, sf, "labels")
    d = table(spark, sf, "documents").select("doc_id", F.length("text").alias("len"))
    j = lab.join(d, "doc_id")
    return j.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.min("len").alias("min_len"),
                                    F.max("len").alias("max_len"), F.round(F.avg("len"), 9).alias("mean_len"))


_ORDER_NUMBERS = ["o_orderkey", "o_custkey", "o_totalprice"]  # every number of orders


def _moments_sql(c: str, part: str, cond: str) -> str:
    return (f"(SELECT count({c}) AS count_{part}, avg({c}) AS mean_{part}, stddev_samp({c}) AS std_{part} FROM orders "
            f"WHERE o_orderdate {cond} TIMESTAMP '1999-01-01')")


@query("compare_splits", " UNION ALL ".join(f"""
SELECT '{c}' AS column, count_train, round(mean_train, 9) AS mean_train, round(std_train, 6) AS std_train,
       count_test, round(mean_test, 9) AS mean_test, round(std_test, 6) AS std_test,
       round(mean_test - mean_train, 9) AS mean_diff FROM {_moments_sql(c, "train", "<")}, {_moments_sql(c, "test", ">=")}"""
                                               for c in _ORDER_NUMBERS))
def compare_splits_q(spark, sf):
    """Train vs test drift table of every number of orders."""
    o = table(spark, sf, "orders")
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    return _round_all(compare_splits(o.filter(F.col("o_orderdate") < cut), o.filter(F.col("o_orderdate") >= cut),
                                     _ORDER_NUMBERS), nine=("mean_train", "mean_test", "mean_diff"))


# ---------------------------------------------------------------- metrics

@query("binary_metrics", f"""
WITH c AS (SELECT count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp,
                  count(*) FILTER (WHERE label = 0 AND score >= 0.5) AS fp,
                  count(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn,
                  count(*) FILTER (WHERE label = 0 AND score < 0.5) AS tn FROM {_SCORED_SQL})
SELECT tp, fp, fn, tn,
  round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 9) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 9) AS recall,
  round(CASE WHEN tp + fp + fn + tn > 0 THEN (tp + tn) / (tp + fp + fn + tn) ELSE 0 END, 9) AS accuracy,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 9) AS f1 FROM c""")
def binary_metrics_q(spark, sf):
    """M1/M5: precision, recall, accuracy, F1 at threshold 0.5."""
    return _round_all(binary_metrics(scored(spark, sf), "label", "score", 0.5), 9)


@query("roc_auc", f"""
WITH r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk
           FROM {_SCORED_SQL}),
a AS (SELECT sum(rk) FILTER (WHERE label = 1) AS rs, count(*) FILTER (WHERE label = 1) AS np,
             count(*) FILTER (WHERE label = 0) AS nn FROM r)
SELECT round((rs - np * (np + 1) / 2.0) / (np * nn), 9) AS auc, np AS n_pos, nn AS n_neg FROM a""")
def roc_auc_q(spark, sf):
    """M2: exact ROC AUC with averaged ties."""
    return _round_all(roc_auc(scored(spark, sf), "label", "score"), 9)


@query("confusion_matrix", f"""
SELECT label, count(*) FILTER (WHERE score < 0.5) AS "0", count(*) FILTER (WHERE score >= 0.5) AS "1"
FROM {_SCORED_SQL} GROUP BY label""")
def confusion_matrix_q(spark, sf):
    """M3: label x prediction counts."""
    s = scored(spark, sf).withColumn("pred", (F.col("score") >= 0.5).cast("int"))
    return confusion_matrix(s, "label", "pred")


@query("exact_match_accuracy", """
SELECT CAST(round(avg(CAST(
  list_transform(range(64), lambda i: CAST(label = i AS INTEGER)) =
  list_transform(range(64), lambda i: CAST(list_position(embedding, list_max(embedding)) - 1 = i AS INTEGER))
  AS DOUBLE)) * 100) AS BIGINT) AS accuracy_pct FROM embeddings""")
def exact_match_accuracy_q(spark, sf):
    """Share of rows whose one-hot prediction vector equals the truth, %."""
    e = table(spark, sf, "embeddings")
    pred_idx = argmax_index("embedding") - 1
    one_hot = lambda k: F.transform("embedding", lambda x, i: (i == k).cast("int"))
    truth, pred = one_hot(F.col("label")), one_hot(pred_idx)
    return exact_match_accuracy(e.select(truth.alias("t"), pred.alias("p")), "t", "p")


@query("threshold_sweep", f"""
WITH g AS (SELECT k, k * CAST(0.001 AS DOUBLE) AS t FROM generate_series(0, 999) s(k)),
c AS (SELECT g.k, g.t, count(*) FILTER (WHERE s.label = 1 AND s.score >= g.t) AS tp,
             count(*) FILTER (WHERE s.label = 0 AND s.score >= g.t) AS fp,
             count(*) FILTER (WHERE s.label = 1 AND s.score < g.t) AS fn
      FROM g CROSS JOIN {_SCORED_SQL} s GROUP BY 1, 2),
f AS (SELECT k, t, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1 FROM c)
SELECT CASE WHEN f1 > 0 THEN t ELSE 0.0 END AS threshold, round(f1, 9) AS f1 FROM f ORDER BY f1 DESC, k LIMIT 1""")
def threshold_sweep_q(spark, sf):
    """F1-best threshold over 0, .001, ..., .999 (first best wins)."""
    out = best_f1_threshold(scored(spark, sf), "label", "score")
    return out.select("threshold", F.round("f1", 9).alias("f1"))


@query("mape", """
SELECT CAST(round(avg(abs((l_extendedprice - l_quantity * 1500) / NULLIF(l_extendedprice, 0))) * 100) AS BIGINT) AS mape_pct,
       round(avg(abs((l_extendedprice - l_quantity * 1500) / NULLIF(l_extendedprice, 0))), 6) AS mape FROM lineitem""")
def mape_q(spark, sf):
    """Mean absolute percentage error."""
    li = table(spark, sf, "lineitem")
    return _round_all(mape(li, "l_extendedprice", F.col("l_quantity") * 1500))


@query("mae_mse", """
SELECT round(avg(abs(l_extendedprice - l_quantity * 1500)), 4) AS mae,
       round(avg(pow(l_extendedprice - l_quantity * 1500, 2)), 2) AS mse FROM lineitem""")
def mae_mse_q(spark, sf):
    """M8: mean absolute and squared error."""
    out = mae_mse(table(spark, sf, "lineitem"), "l_extendedprice", F.col("l_quantity") * 1500)
    return out.select(F.round("mae", 4).alias("mae"), F.round("mse", 2).alias("mse"))


@query("log_loss", f"""
SELECT round(avg(-(label * ln(p) + (1 - label) * ln(1 - p))), 6) AS log_loss
FROM (SELECT label, least(greatest(score, 1e-15), 1 - 1e-15) AS p FROM {_SCORED_SQL})""")
def log_loss_q(spark, sf):
    """M9: clipped binary cross-entropy."""
    return _round_all(log_loss(scored(spark, sf), "label", "score"))


@query("compare_scores", """
SELECT count(*) FILTER (WHERE round(value) = ceil(value - 0.5)) AS n_identical,
       count(*) FILTER (WHERE round(value) <> ceil(value - 0.5)) AS n_different FROM events""")
def compare_scores_q(spark, sf):
    """Two models' scores joined on the key; identical vs different counts."""
    ev = table(spark, sf, "events")
    a = ev.select("event_id", F.round("value").alias("s"))
    b = ev.select("event_id", F.ceil(F.col("value") - 0.5).cast("double").alias("s"))
    return compare_scores(a, b, "event_id", "s", "s")


_TRIAL_JSON_SQL = """(SELECT json_object('trialId', CAST(s_suppkey AS VARCHAR),
     'hyperparameters', json_object('max_depth', CAST(s_nationkey % 8 + 2 AS VARCHAR),
                                    'n_estimators', CAST(50 + s_suppkey % 100 AS VARCHAR)),
     'finalMetric', json_object('trainingStep', 1000, 'objectiveValue', round(abs(s_acctbal) / 10000, 6))) AS doc
  FROM supplier)"""


@query("trial_table", f"""
SELECT CAST(json_extract_string(doc, '$.trialId') AS BIGINT) AS trial_id,
       CAST(json_extract_string(doc, '$.hyperparameters.max_depth') AS INTEGER) AS max_depth,
       CAST(json_extract_string(doc, '$.hyperparameters.n_estimators') AS INTEGER) AS n_estimators,
       CAST(json_extract(doc, '$.finalMetric.objectiveValue') AS DOUBLE) AS objective
FROM {_TRIAL_JSON_SQL}
ORDER BY objective DESC, trial_id LIMIT 1""")
def trial_table_q(spark, sf):
    """Parse trial JSON (id, hyper-parameter map, final metric) into a
    table and keep the best trial by objective."""
    sup = table(spark, sf, "supplier")
    doc = F.to_json(F.struct(
        F.col("s_suppkey").cast("string").alias("trialId"),
        F.create_map(F.lit("max_depth"), (F.col("s_nationkey") % 8 + 2).cast("string"),
                     F.lit("n_estimators"), (50 + F.col("s_suppkey") % 100).cast("string")).alias("hyperparameters"),
        F.struct(F.lit(1000).alias("trainingStep"),
                 F.round(F.abs("s_acctbal") / 10000, 6).alias("objectiveValue")).alias("finalMetric")))
    trials = trial_table(sup.select(doc.alias("doc")), "doc", ["max_depth", "n_estimators"])
    parsed = trials.select("trial_id", F.col("max_depth").cast("int").alias("max_depth"),
                           F.col("n_estimators").cast("int").alias("n_estimators"), "objective")
    return best_trial(parsed, "objective")
