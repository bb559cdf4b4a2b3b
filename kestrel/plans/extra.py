"""Profile report, plot data, calendar shares, named arrays, images, score rows, a minimising
search and the pitch flow (E16, E17, W10, F28, F29, R8, G6, M10, SURVEY 3b)."""

from __future__ import annotations

import datetime as dt

from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from ..functions.arrays import center_fit_image
from ..operators.metrics import best_f1_threshold, binary_metrics
from ..operators.ml import fit_rf, one_vs_rest_models, random_search, stacked_scores
from ..operators.profile import histogram, profile_report
from ..operators.reshape import vocabulary
from ..operators.split import sample_n, stratified_split
from ..operators.timeseries import class_share_by
from ..session import cut_lineage, scratch_path, table
from ..sources.sinks import append_rows
from .models import METRIC_SCHEMA, emb_rows
from .registry import query

_CUSTOMER = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_mktsegment": "string",
             "c_acctbal": "double"}
_NUMBERS = ("c_custkey", "c_nationkey", "c_acctbal")


def _top_sql(column: str, top: int = 3) -> str:
    return (f"(SELECT list({{'value': value, 'n': n}} ORDER BY n DESC, value) FROM (SELECT CAST({column} AS VARCHAR) AS value, "
            f"count(*) AS n FROM customer WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT {top}))")


def _stats_sql(c: str) -> str:
    if c not in _NUMBERS:
        return "NULL::BIGINT AS count, " + ", ".join(f"NULL::DOUBLE AS {x}" for x in ("mean", "std", "min", "p25", "p50", "p75",
                                                                                     "max"))
    parts = [("mean", f"avg({c})", 6), ("std", f"stddev_samp({c})", 6), ("min", f"min({c})", 6),
             ("p25", f"quantile_cont({c}, 0.25)", 6), ("p50", f"quantile_cont({c}, 0.5)", 6),
             ("p75", f"quantile_cont({c}, 0.75)", 6), ("max", f"max({c})", 6)]
    return f"(SELECT count({c}) FROM customer) AS count, " + ", ".join(
        f"(SELECT round(CAST({x} AS DOUBLE), {d}) FROM customer) AS {n}" for n, x, d in parts)


@query("profile_report", "SELECT * EXCLUDE (t), list_transform(t, lambda x: x.value) AS top_values, "
       "list_transform(t, lambda x: x.n) AS top_counts FROM (" + " UNION ALL ".join(
           f"SELECT '{c}' AS c, '{k}' AS dtype, (SELECT count(DISTINCT {c}) FROM customer) AS unique, "
           f"(SELECT count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) FROM customer) AS missing_pct, "
           f"{_stats_sql(c)}, {_top_sql(c)} AS t" for c, k in _CUSTOMER.items()) + ")")
def profile_report_q(spark, sf):
    """Type, distinct count, missing %, all statistics and the three most frequent values of
    each column."""
    out = profile_report(table(spark, sf, "customer").select(*_CUSTOMER), top=3)
    stats = [F.round(c, 6).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")]
    return out.select(F.col("column").alias("c"), "dtype", "unique", "missing_pct", "count", *stats,
                      F.transform("top_values", lambda x: x["value"]).alias("top_values"),
                      F.transform("top_values", lambda x: x["n"]).alias("top_counts"))


@query("pair_plot_points", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag FROM lineitem
ORDER BY md5('3|' || l_orderkey || '|' || l_linenumber), l_orderkey, l_linenumber LIMIT 500""")
def pair_plot_points_q(spark, sf):
    """The points behind a pair plot: 500 seeded rows of the plotted columns and the class."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                                             "l_returnflag")
    return sample_n(li, 500, seed=3, key=["l_orderkey", "l_linenumber"])


@query("facet_counts", """
WITH st AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem),
c AS (SELECT l_returnflag, CAST(least(floor((l_quantity - lo) / ((hi - lo) / 8)), 7) AS INTEGER) AS bin, count(*) AS n
      FROM lineitem, st GROUP BY 1, 2)
SELECT f.l_returnflag, CAST(b.bin AS INTEGER) AS bin, coalesce(c.n, 0) AS "count"
FROM (SELECT DISTINCT l_returnflag FROM lineitem) f CROSS JOIN generate_series(0, 7) b(bin)
LEFT JOIN c ON c.l_returnflag = f.l_returnflag AND c.bin = b.bin""")
def facet_counts_q(spark, sf):
    """The counts behind a histogram in one facet per class."""
    return histogram(table(spark, sf, "lineitem"), "l_quantity", 8, by="l_returnflag").select("l_returnflag", "bin", "count")


@query("heat_map_cells", """
SELECT CAST(isodow(ts) AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n,
       round(avg(value), 9) AS mean_value FROM events GROUP BY 1, 2""")
def heat_map_cells_q(spark, sf):
    """The cells behind a weekday x hour heat map."""
    ev = table(spark, sf, "events")
    return ev.groupBy((F.weekday("ts") + 1).alias("weekday"), F.hour("ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 9).alias("mean_value"))


def _share_sql(part: str, name: str) -> str:
    return f"""
SELECT {name}, event_type, n, round(n / sum(n) OVER (PARTITION BY {name}), 9) AS share FROM (
  SELECT CAST({part} AS INTEGER) AS {name}, event_type, count(*) AS n FROM events GROUP BY 1, 2)"""


@query("class_share_by_weekday", _share_sql("isodow(ts)", "weekday"))
def class_share_by_weekday_q(spark, sf):
    """Class shares within each weekday (1 = Monday)."""
    out = class_share_by(table(spark, sf, "events"), (F.weekday("ts") + 1).alias("weekday"), "event_type")
    return out.withColumn("share", F.round("share", 9))


@query("class_share_by_hour", _share_sql("hour(ts)", "hour"))
def class_share_by_hour_q(spark, sf):
    """Class shares within each hour of the day."""
    out = class_share_by(table(spark, sf, "events"), F.hour("ts").alias("hour"), "event_type")
    return out.withColumn("share", F.round("share", 9))


@query("json_tag_names", """
SELECT p_partkey, [p_type, p_brand, p_name] AS names FROM part""")
def json_tag_names_q(spark, sf):
    """an array of objects in a JSON text to the list of their names."""
    obj = lambda c: F.struct(F.col(c).alias("name"), F.col("p_size").alias("count"))
    text = F.to_json(F.struct(F.struct(F.array(obj("p_type"), obj("p_brand"), obj("p_name")).alias("tag")).alias("toptags")))
    docs = table(spark, sf, "part").select("p_partkey", text.alias("body"))
    parsed = F.from_json("body", "toptags struct<tag: array<struct<name: string, count: int>>>")
    return docs.select("p_partkey", F.transform(parsed["toptags"]["tag"], lambda t: t["name"]).alias("names"))


@query("image_center_fit", """
SELECT vec_id, list_transform(range(0, 12 * 6 * 3), lambda k:
  CASE WHEN k // 18 - 2 BETWEEN 0 AND 7
       THEN CAST(embedding[(k // 18 - 2) * 8 + (k // 3) % 6 + 1 + 1] AS DOUBLE) * (1 + k % 3) ELSE 0.0 END) AS pixels
FROM embeddings""")
def image_center_fit_q(spark, sf):
    """8 x 8 x 3 images (each vector's 64 values, three channels) padded to 12 rows and
    cropped to 6 columns around the centre; shown as one flat list."""
    x = lambda i: F.col("embedding")[i].cast("double")
    img = F.array(*[F.array(*[F.array(x(8 * r + c), x(8 * r + c) * 2, x(8 * r + c) * 3) for c in range(8)])
                    for r in range(8)])
    fitted = table(spark, sf, "embeddings").select("vec_id", img.alias("img")).select(
        "vec_id", center_fit_image("img", 12, 6).alias("img"))
    return fitted.select("vec_id", F.flatten(F.flatten("img")).alias("pixels"))


_EVENTS = ["click", "error", "purchase", "signup", "view"]


@query("score_map_row", "SELECT user_id, " + ", ".join(
    f"round(max(s) FILTER (WHERE event_type = '{e}'), 6) AS {e}_score" for e in _EVENTS) + """
FROM (SELECT user_id, event_type, avg(value) AS s FROM events GROUP BY 1, 2) GROUP BY user_id""")
def score_map_row_q(spark, sf):
    """Per user a map from name to score, spread to one wide row of ``<name>_score`` columns."""
    ev = table(spark, sf, "events")
    scores = ev.groupBy("user_id", "event_type").agg(F.round(F.avg("value"), 6).alias("s"))
    maps = scores.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "s"))).alias("m"))
    return maps.select("user_id", *[F.col("m")[e].alias(f"{e}_score") for e in vocabulary(ev, "event_type")])


@query("param_search_minimise")
def param_search_minimise_q(spark, sf):
    """Draws of a declared space, the least hold-out error is best; one named metric row
    per trial, the best one marked."""
    li = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", F.col("l_extendedprice").alias("label"))
    space = {"regParam": ("log", 1e-3, 1e5), "maxIter": ("choice", [5, 20])}
    _, trials = random_search(LinearRegression(labelCol="label", featuresCol="features"), space, 4, li, "label",
                              ["l_quantity", "l_discount", "l_tax"], metric="rmse", seed=3, minimise=True)
    best = min(t["metric"] for t in trials)
    rows = [(t["trial"], "rmse", t["metric"], t["regParam"], t["maxIter"], t["metric"] == best) for t in trials]
    return spark.createDataFrame(rows, "trial int, metric string, value double, regParam double, maxIter int, best boolean")


def pitch_flow(spark, rows, date: str):
    """The pitch flow: exact per-class split, one boosted model per class, F1-best threshold on
    the validation rows, one metric row per class on the test rows, then a forest over the
    validation rows' class scores that names the test rows' class.

    ``rows``: vec_id, label, features. Returns (metric rows, test rows with label and prediction).
    """
    split = cut_lineage(stratified_split(rows, "label", "vec_id", [("train", 0.6), ("val", 0.2), ("test", 0.2)]))
    classes = vocabulary(rows, "label", max_values=1000)
    train = split.filter(F.col("part") == "train").drop("part")
    models = one_vs_rest_models(train, "label", classes, ["features"], maxIter=5, maxDepth=3)
    scored = cut_lineage(stacked_scores(split.filter(F.col("part") != "train"), models).drop("features"))
    val, test = (scored.filter(F.col("part") == p).drop("part") for p in ("val", "test"))
    path = scratch_path(spark, "pitch-metrics")
    for c in classes:
        y = (F.col("label") == c).cast("int")
        t = best_f1_threshold(val, y, f"{c}_pred").first()["threshold"]
        row = binary_metrics(test, y, f"{c}_pred", t).select(
            F.lit("gbt").alias("model_type"), F.lit(f"class_{c}").alias("pitch_type"), "precision", "accuracy", "recall",
            "f1", F.lit(float(t)).alias("threshold"), F.lit(date).alias("date"))
        append_rows(row, path, METRIC_SCHEMA)
    forest = fit_rf(val, "label", [f"{c}_pred" for c in classes], num_trees=20)
    named = forest.transform(test).select("vec_id", "label", F.col("prediction").cast("int").alias("predicted"))
    return spark.read.parquet(path), named


@query("pitch_flow")
def pitch_flow_q(spark, sf):
    """SURVEY 3b (L11, G11, M6, M10, K5, G12): the metric rows of every class and of the stack."""
    rows = emb_rows(spark, sf)
    metrics, named = pitch_flow(spark, rows, dt.date(2026, 1, 1).isoformat())
    stack = named.agg(F.avg((F.col("label") == F.col("predicted")).cast("double")).alias("accuracy"))
    last = stack.select(F.lit("stack").alias("model_type"), F.lit("all").alias("pitch_type"), "accuracy")
    return metrics.unionByName(last, allowMissingColumns=True)
