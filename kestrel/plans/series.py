"""Window and time-series queries.

Series queries run on the hourly signal of ``events`` (mean value per hour): the
stand-in for one sensor file per time step.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arrays import array_scale, center_fit, mean_abs_diff
from ..functions.dates import parse_file_time, trunc_ntz
from ..operators.ordering import row_index
from ..operators.series_chunks import augmented_dickey_fuller
from ..operators.timeseries import (acf, adf_no_lag, anomaly_flags, class_share_by, first_valid, normal_pdf_grid,
                                    pacf, sd_class, seasonal_decompose, split_first)
from ..session import table
from .registry import query

PERIOD = 24
NLAGS = 100


def hourly_signal(spark, sf):
    """One row per event type (series) and hour: mean value of the events in that hour."""
    ev = table(spark, sf, "events")
    return ev.groupBy("event_type", trunc_ntz("ts", "hour").alias("hour")).agg(F.avg("value").alias("v"))


_HOURLY_SQL = "(SELECT event_type, date_trunc('hour', ts) AS hour, avg(value) AS v FROM events GROUP BY 1, 2)"
_SERIES = "PARTITION BY event_type ORDER BY"


@query("first_vs_rest", """
SELECT o_custkey, o_orderkey, CASE WHEN rk = 1 THEN 'target' ELSE 'rest' END AS part FROM (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rk,
         count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) WHERE n >= 2""")
def first_vs_rest_q(spark, sf):
    """First order of each customer is the target row, the rest are features;
    single-order customers are dropped."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    target, rest = split_first(o, "o_custkey", ["o_orderdate", "o_orderkey"])
    return (target.select("o_custkey", "o_orderkey", F.lit("target").alias("part"))
            .unionByName(rest.select("o_custkey", "o_orderkey", F.lit("rest").alias("part"))))


_PRIO_NULLS = "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END"


@query("first_value", f"""
SELECT o_custkey, first_priority FROM (
  SELECT o_custkey, {_PRIO_NULLS} AS first_priority,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rk
  FROM orders WHERE {_PRIO_NULLS} IS NOT NULL) WHERE rk = 1""")
def first_value_q(spark, sf):
    """First non-missing value per customer in date order."""
    o = table(spark, sf, "orders")
    base = o.select("o_custkey", "o_orderdate", "o_orderkey",
                    F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("priority"))
    return first_valid(base, "o_custkey", "priority", ["o_orderdate", "o_orderkey"], "first_priority")


@query("row_index", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_idx FROM orders""")
def row_index_q(spark, sf):
    """0..n-1 position in (date, key) order, numbered without a one-task window."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return row_index(o, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "row_idx")


@query("parse_sort_time", """
SELECT event_id, strftime(ts, '%Y.%m.%d.%H.%M.%S') AS fname,
       strptime(strftime(ts, '%Y.%m.%d.%H.%M.%S'), '%Y.%m.%d.%H.%M.%S') AS file_ts FROM events""")
def parse_sort_time_q(spark, sf):
    """Time parsed from a 'yyyy.MM.dd.HH.mm.ss' file name, then sorted."""
    ev = table(spark, sf, "events")
    fname = F.date_format("ts", "yyyy.MM.dd.HH.mm.ss")
    return ev.select("event_id", fname.alias("fname"), parse_file_time(fname).alias("file_ts")).orderBy("file_ts", "event_id")


@query("seasonal_decompose", f"""
WITH i AS (SELECT event_type, hour, v, row_number() OVER ({_SERIES} hour) - 1 AS idx,
                  count(*) OVER (PARTITION BY event_type) AS n FROM {_HOURLY_SQL}),
t AS (SELECT event_type, hour, idx, v, CASE WHEN idx >= {PERIOD // 2} AND idx + {PERIOD // 2} <= n - 1 THEN
        (sum(v) OVER ({_SERIES} idx ROWS BETWEEN {PERIOD // 2} PRECEDING AND {PERIOD // 2} FOLLOWING)
         - 0.5 * lag(v, {PERIOD // 2}) OVER ({_SERIES} idx) - 0.5 * lead(v, {PERIOD // 2}) OVER ({_SERIES} idx)) / {PERIOD}
        END AS trend FROM i),
p AS (SELECT event_type, idx % {PERIOD} AS phase, avg(v - trend) AS pa FROM t GROUP BY 1, 2),
pc AS (SELECT event_type, phase, pa - avg(pa) OVER (PARTITION BY event_type) AS seasonal FROM p)
SELECT t.event_type, t.hour, t.idx, round(t.v, 9) AS v, round(t.trend, 9) AS trend, round(pc.seasonal, 9) AS seasonal,
       round(t.v - t.trend - pc.seasonal, 9) AS resid
FROM t JOIN pc ON t.idx % {PERIOD} = pc.phase AND t.event_type = pc.event_type""")
def seasonal_decompose_q(spark, sf):
    """Additive decomposition of each event type's hourly signal, daily period."""
    out = seasonal_decompose(hourly_signal(spark, sf), "hour", "v", PERIOD, keys=["event_type"])
    # sums of 2-decimal values over small divisors: exact decimals, so round clear of 6th-place ties
    return out.select("event_type", "hour", "idx", *[F.round(c, 9).alias(c) for c in ("v", "trend", "seasonal", "resid")])


@query("acf", f"""
WITH i AS (SELECT event_type, row_number() OVER ({_SERIES} hour) - 1 AS idx,
                  v - avg(v) OVER (PARTITION BY event_type) AS dev FROM {_HOURLY_SQL}),
l AS (SELECT a.event_type, g.lag, a.dev * b.dev AS p FROM i a CROSS JOIN generate_series(0, {NLAGS}) g(lag)
      JOIN i b ON b.idx = a.idx + g.lag AND a.event_type = b.event_type),
d AS (SELECT event_type, sum(dev * dev) AS den FROM i GROUP BY 1)
SELECT l.event_type, l.lag, round(sum(l.p) / any_value(d.den), 6) AS acf FROM l JOIN d USING (event_type) GROUP BY 1, 2""")
def acf_q(spark, sf):
    """Autocorrelation of each event type's hourly signal to 100 lags."""
    out = acf(hourly_signal(spark, sf), "hour", "v", NLAGS, keys=["event_type"])
    return out.select("event_type", F.col("lag").cast("long").alias("lag"), F.round("acf", 6).alias("acf"))


@query("pacf", f"""
WITH RECURSIVE i AS (SELECT event_type, row_number() OVER ({_SERIES} hour) - 1 AS idx,
                  v - avg(v) OVER (PARTITION BY event_type) AS dev FROM {_HOURLY_SQL}),
l AS (SELECT a.event_type, g.lag, a.dev * b.dev AS p FROM i a CROSS JOIN generate_series(0, {NLAGS}) g(lag)
      JOIN i b ON b.idx = a.idx + g.lag AND a.event_type = b.event_type),
d AS (SELECT event_type, sum(dev * dev) AS den FROM i GROUP BY 1),
c AS (SELECT l.event_type, l.lag, sum(l.p) / any_value(d.den) AS acf FROM l JOIN d USING (event_type) GROUP BY 1, 2),
r AS (SELECT event_type, list(acf ORDER BY lag) AS r FROM c GROUP BY 1),
dl AS (
  SELECT event_type, r, 1 AS k, r[2] AS a, [r[2]] AS phi, 1 - r[2] * r[2] AS v FROM r WHERE len(r) > 1
  UNION ALL
  SELECT event_type, r, k + 1, b, list_append(list_transform(phi, lambda x, j: x - b * phi[k + 1 - j]), b), v * (1 - b * b)
  FROM (SELECT *, (r[k + 2] - list_sum(list_transform(phi, lambda x, j: x * r[k + 2 - j]))) / v AS b FROM dl
        WHERE k < len(r) - 1))
SELECT event_type, CAST(k AS BIGINT) AS lag, round(a, 6) AS pacf FROM dl
UNION ALL SELECT event_type, 0, 1.0 FROM r""")
def pacf_q(spark, sf):
    """Partial autocorrelation per event type (Durbin-Levinson over the acf)."""
    out = pacf(acf(hourly_signal(spark, sf), "hour", "v", NLAGS, keys=["event_type"]), keys=["event_type"])
    return out.select("event_type", "lag", F.round("pacf", 6).alias("pacf"))


@query("adf_stat", f"""
WITH d AS (SELECT event_type, v - lag(v) OVER ({_SERIES} hour) AS dy, lag(v) OVER ({_SERIES} hour) AS ylag
           FROM {_HOURLY_SQL}),
a AS (SELECT event_type, CAST(regr_count(dy, ylag) AS BIGINT) AS n, regr_slope(dy, ylag) AS slope,
             regr_sxx(dy, ylag) AS sxx, regr_syy(dy, ylag) AS syy, regr_sxy(dy, ylag) AS sxy
      FROM d WHERE dy IS NOT NULL GROUP BY 1)
SELECT event_type, n, round(slope / sqrt((syy - slope * sxy) / (n - 2) / sxx), 6) AS adf_stat,
       round(-3.43035 + -6.5393 / n + -16.786 / (n * n) + -79.433 / (n * n * n), 6) AS crit_1,
       round(-2.86154 + -2.8903 / n + -4.234 / (n * n) + -40.040 / (n * n * n), 6) AS crit_5,
       round(-2.56677 + -1.5384 / n + -2.809 / (n * n) + 0.0 / (n * n * n), 6) AS crit_10 FROM a""")
def adf_stat_q(spark, sf):
    """Dickey-Fuller statistic (constant, no lags) and critical values per event type."""
    out = adf_no_lag(hourly_signal(spark, sf), "hour", "v", keys=["event_type"])
    return out.select("event_type", "n", *[F.round(c, 6).alias(c) for c in ("adf_stat", "crit_1", "crit_5", "crit_10")])


@query("adf_lags")
def adf_lags_q(spark, sf):
    """Augmented Dickey-Fuller test per event type, lag order by AIC; its values are tested against
    least squares on small series."""
    return augmented_dickey_fuller(hourly_signal(spark, sf), "hour", "v", keys=["event_type"])


def event_series(spark, sf):
    """All events as one long series, one step an event."""
    ev = table(spark, sf, "events")
    return ev.select(F.struct("ts", "event_id").alias("step"), "event_id", "value")


_EVENT_STEPS = """(SELECT event_id, value AS v, row_number() OVER (ORDER BY ts, event_id) - 1 AS idx, count(*) OVER () AS n,
                   value - avg(value) OVER () AS dev FROM events)"""
_LONG_CHUNK, _LONG_LAGS = 512, 40


@query("long_series_decompose", f"""
WITH t AS (SELECT idx, v, CASE WHEN idx >= 50 AND idx + 50 <= n - 1 THEN
        (sum(v) OVER (ORDER BY idx ROWS BETWEEN 50 PRECEDING AND 50 FOLLOWING)
         - 0.5 * lag(v, 50) OVER (ORDER BY idx) - 0.5 * lead(v, 50) OVER (ORDER BY idx)) / 100 END AS trend
      FROM {_EVENT_STEPS}),
p AS (SELECT idx % 100 AS phase, avg(v - trend) AS pa FROM t GROUP BY 1),
pc AS (SELECT phase, pa - avg(pa) OVER () AS seasonal FROM p)
SELECT t.idx, round(t.trend, 6) AS trend, round(pc.seasonal, 6) AS seasonal, round(t.v - t.trend - pc.seasonal, 6) AS resid
FROM t JOIN pc ON t.idx % 100 = pc.phase""")
def long_series_decompose_q(spark, sf):
    """One series without a key, period 100, spread over chunks with halo rows."""
    out = seasonal_decompose(event_series(spark, sf), "step", "value", 100, chunk=_LONG_CHUNK)
    return out.select("idx", *[F.round(c, 6).alias(c) for c in ("trend", "seasonal", "resid")])


@query("long_series_acf", f"""
WITH i AS (SELECT idx, dev FROM {_EVENT_STEPS}),
l AS (SELECT idx, unnest([{", ".join(f"dev * lag(dev, {k}) OVER (ORDER BY idx)" for k in range(_LONG_LAGS + 1))}]) AS p,
             unnest(range({_LONG_LAGS + 1})) AS lag FROM i)
SELECT lag, round(sum(p) / (SELECT sum(dev * dev) FROM i), 9) AS acf FROM l GROUP BY lag""")
def long_series_acf_q(spark, sf):
    """Autocorrelation of one series without a key, spread over chunks with halo rows."""
    out = acf(event_series(spark, sf), "step", "value", _LONG_LAGS, chunk=_LONG_CHUNK)
    return out.select(F.col("lag").cast("long").alias("lag"), F.round("acf", 9).alias("acf"))


@query("sd_class", """
WITH s AS (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS sd FROM orders)
SELECT o_orderkey, CASE WHEN o_totalprice > m + 3 * sd THEN 'Very Large'
  WHEN o_totalprice <= m + 3 * sd AND o_totalprice > m + sd THEN 'Large'
  WHEN o_totalprice <= m + sd AND o_totalprice >= m - sd THEN 'Medium'
  WHEN o_totalprice < m - sd THEN 'Short' END AS segment FROM orders, s""")
def sd_class_q(spark, sf):
    """Four distance classes from whole-table mean and sd."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return sd_class(o, "o_totalprice").select("o_orderkey", "segment")


@query("class_share_by_month", """
SELECT month, o_orderpriority, n, round(n / sum(n) OVER (PARTITION BY month), 9) AS share FROM (
  SELECT CAST(month(o_orderdate) AS INTEGER) AS month, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)""")
def class_share_by_month_q(spark, sf):
    """Class shares within each month."""
    o = table(spark, sf, "orders")
    out = class_share_by(o, F.month("o_orderdate").alias("month"), "o_orderpriority")
    return out.withColumn("share", F.round("share", 9))


@query("row_mae", """
WITH e AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
c AS (SELECT label, pos, avg(x) AS c FROM e GROUP BY 1, 2)
SELECT e.vec_id, round(avg(abs(e.x - c.c)), 6) AS mae FROM e JOIN c ON e.label = c.label AND e.pos = c.pos GROUP BY 1""")
def row_mae_q(spark, sf):
    """Per-row mean |vector - its class centroid| over positions."""
    e = table(spark, sf, "embeddings")
    long = e.select("label", F.posexplode("embedding").alias("pos", "x"))
    cent = long.groupBy("label", "pos").agg(F.avg("x").alias("c"))
    # one array per class, bounded by (classes x dimensions); size-checked broadcast
    arrs = cent.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "c"))).alias("_s")) \
        .select("label", F.transform("_s", lambda s: s["c"]).alias("centroid"))
    j = e.join(arrs, "label")
    return j.select("vec_id", F.round(mean_abs_diff("embedding", "centroid"), 6).alias("mae"))


@query("anomaly_flag", f"""
WITH s AS (SELECT date_trunc('hour', ts) AS hour, avg(abs(value)) AS score FROM events GROUP BY 1),
t AS (SELECT 1.05 * max(score) AS thr FROM s WHERE hour < TIMESTAMP '2024-01-21 00:00:00')
SELECT hour, round(score, 9) AS score, round(thr, 9) AS threshold, score > thr AS anomaly FROM s, t""")
def anomaly_flag_q(spark, sf):
    """threshold = 1.05 x max training-period score; flag = score > threshold."""
    ev = table(spark, sf, "events")
    s = ev.groupBy(trunc_ntz("ts", "hour").alias("hour")).agg(F.avg(F.abs("value")).alias("score"))
    out = anomaly_flags(s, "score", F.col("hour") < F.lit("2024-01-21 00:00:00").cast("timestamp_ntz"))
    return out.select("hour", F.round("score", 9).alias("score"), F.round("threshold", 9).alias("threshold"), "anomaly")


@query("normal_pdf_grid", """
WITH s AS (SELECT avg(value) AS mu, sqrt(var_samp(value)) AS sigma FROM events)
SELECT CAST(i AS INTEGER) AS i, round(mu - 3 * sigma + i * (6 * sigma / 99), 6) AS x,
       round(exp(-pow((mu - 3 * sigma + i * (6 * sigma / 99) - mu) / sigma, 2) / 2) / (sigma * sqrt(2 * pi())), 9) AS pdf
FROM s, generate_series(0, 99) g(i)""")
def normal_pdf_grid_q(spark, sf):
    """normal density on 100 even points over mean +/- 3 sd of the score."""
    g = normal_pdf_grid(table(spark, sf, "events"), "value")
    return g.select("i", F.round("x", 6).alias("x"), F.round("pdf", 9).alias("pdf"))


# ---------------------------------------------------------------- arrays

@query("array_scan", "SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dim, embedding FROM embeddings")
def array_scan_q(spark, sf):
    """image/label dataset load with the array column as the image."""
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", "label", F.size("embedding").alias("dim"), "embedding")


@query("array_flatten_size", """
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS n, CAST(len(flatten([embedding, embedding])) AS INTEGER) AS n_flat,
       CAST(len([embedding]) AS INTEGER) AS n_outer FROM embeddings""")
def array_flatten_size_q(spark, sf):
    """Reshape [f] <-> [1, f], flatten nested arrays, sizes."""
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.size("embedding").alias("n"),
                    F.size(F.flatten(F.array("embedding", "embedding"))).alias("n_flat"),
                    F.size(F.array("embedding")).alias("n_outer"))


@query("array_center_fit", """
SELECT vec_id, list_slice(embedding, 9, 56) AS crop48,
       list_concat(list_concat(list_transform(range(8), lambda x: CAST(0.0 AS FLOAT)), embedding),
                   list_transform(range(8), lambda x: CAST(0.0 AS FLOAT))) AS pad80 FROM embeddings""")
def array_center_fit_q(spark, sf):
    """Centre crop 64 -> 48 and centre pad 64 -> 80."""
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", center_fit("embedding", 48).alias("crop48"), center_fit("embedding", 80).alias("pad80"))


@query("array_scale", """
SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE) / 255.0) AS scaled FROM embeddings""")
def array_scale_q(spark, sf):
    """Element-wise scale to [0, 1] style (divide by 255)."""
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", array_scale("embedding").alias("scaled"))


@query("nested_measure_flatten", """
SELECT event_id, y.Name AS name, pos, d AS data FROM (
  SELECT event_id, unnest([{'Name': 'value', 'Data': [value, value * 2]},
                           {'Name': 'k', 'Data': [CAST(json_extract(props, '$.k') AS DOUBLE)]}]) AS y FROM events)
  , LATERAL (SELECT unnest(y.Data) AS d, generate_subscripts(y.Data, 1) - 1 AS pos)""")
def nested_measure_flatten_q(spark, sf):
    """a nested measurement record (Info + array of named Data arrays) flattened
    to one row per (record, channel name, position) with inline + posexplode."""
    ev = table(spark, sf, "events")
    rec = ev.select(F.struct(F.col("event_id").alias("id"), F.col("ts").alias("ts")).alias("Info"),
                    F.array(F.struct(F.lit("value").alias("Name"),
                                     F.array(F.col("value"), F.col("value") * 2).alias("Data")),
                            F.struct(F.lit("k").alias("Name"),
                                     F.array(F.get_json_object("props", "$.k").cast("double")).alias("Data"))).alias("Y"))
    y = rec.select(F.col("Info.id").alias("event_id"), F.inline("Y"))
    return y.select("event_id", F.col("Name").alias("name"), F.posexplode("Data").alias("pos", "data")) \
        .select("event_id", "name", F.col("pos").cast("long").alias("pos"), "data")
