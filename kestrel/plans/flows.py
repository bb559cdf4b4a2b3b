"""End-to-end project flows composed from the library's operators (§3, build step 11).

Each flow reads the driver tables in full and ends in a fitted model and its
evaluation, so the checks are rows-only. Stand-ins follow FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import time_parts, two_digit_year_date, weekday_name
from ..functions.geo import haversine_m
from ..functions.strings import suffix_collapse, zip_prefix
from ..operators.aggregate import group_count
from ..operators.clean import LOAN_RULES, apply_rules, impute_mode, tokens_to_null
from ..operators.features import LabelEncode, MinMax, OneHot, class_weight
from ..operators.metrics import binary_metrics, exact_match_accuracy, mape, roc_auc
from ..operators.ml import fit_gbt, fit_log_regression, fit_rf, pca_residual, positive_probability
from ..operators.project import map_values, ordinal_case
from ..operators.reshape import align_columns, count_vector, vocabulary
from ..operators.split import date_range_split, hash_split, mod_split, time_split
from ..operators.timeseries import anomaly_flags, split_first
from ..session import FIT_ROWS, cut_lineage, scratch_path, table
from ..sources.files import read_delimited
from ..sources.sinks import write_delimited
from .columns import AGE_BAND_CODES
from .registry import query


@query("taxi_flow")
def taxi_flow_q(spark, sf):
    """Taxi duration (§3a): trips filtered to 60..7200 s with a positive distance,
    geodesic distance and calendar parts, area codes with 9999 for missing, stable
    80/10/10 hash split, weekday one-hot and min-max fitted on train, boosted
    regression on ln(seconds), MAPE per evaluation part."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_shipdate")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    trips = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("unique_key"),
        (F.col("l_quantity") * 150).alias("trip_seconds"),
        "o_orderdate",
        (F.lit(-87.6) + (F.col("c_custkey") % 100) / 1000.0).alias("lon1"),
        (F.lit(41.8) + F.col("c_nationkey") / 100.0).alias("lat1"),
        (F.lit(-87.7) + (F.col("l_orderkey") % 97) / 500.0).alias("lon2"),
        (F.lit(41.9) - (F.col("l_orderkey") % 89) / 500.0).alias("lat2"),
        F.nullif(F.col("c_nationkey") % 7, F.lit(0)).alias("pickup_area"))
    dist = haversine_m("lon1", "lat1", "lon2", "lat2")
    feats = (trips.withColumn("distance", dist)
             .filter(F.col("trip_seconds").between(60, 7200) & (F.col("distance") > 0))
             .select("unique_key", F.ln("trip_seconds").alias("log_trip_seconds"), "trip_seconds", "distance",
                     *time_parts("o_orderdate"), weekday_name("o_orderdate").alias("weekday"),
                     F.coalesce("pickup_area", F.lit(9999)).alias("pickup_area")))
    # the joined, filtered feature rows are written once; fits and scoring read them
    parts = cut_lineage(hash_split(feats, "unique_key", [("train", 8), ("valid", 1), ("test", 1)]), FIT_ROWS)
    train = parts.filter(F.col("part") == "train")
    oh = OneHot.fit(train, ["weekday"])
    mm = MinMax.fit(train, ["distance", "month", "hour"])
    ready = mm.transform(oh.transform(parts, wide=True))
    cols = ["distance", "month", "hour", "pickup_area"] + oh.wide_columns()
    model = fit_log_regression(ready.filter(F.col("part") == "train"), "trip_seconds", cols, maxIter=10, maxDepth=4)
    scored = model.transform(ready.filter(F.col("part").isin("valid", "test")))
    return mape(scored.withColumn("pred_seconds", F.exp("prediction")), "trip_seconds", "pred_seconds", by="part")


@query("bearing_flow")
def bearing_flow_q(spark, sf):
    """Bearing anomaly (§3c): one sensor file per 6 hours written and read back with
    its file name, reduced to the mean |value| of each channel (event type) per file, time
    split at a cut (boundary file in both parts), min-max fitted on train, PCA(2)
    reconstruction error, anomaly = error > 1.05 x the largest training error."""
    path = scratch_path(spark, "sensor-files")
    e = table(spark, sf, "events")
    six_hours = F.make_timestamp_ntz(F.year("ts"), F.month("ts"), F.dayofmonth("ts"),
                                     F.floor(F.hour("ts") / 6) * 6, F.lit(0), F.lit(0))
    ev = e.select(F.date_format(six_hours, "yyyy.MM.dd.HH.mm.ss").alias("file"), "event_type", "value")
    # a folder per file; a long file's rows are salted over several tasks (and part files)
    write_delimited(ev.repartition("file", F.pmod(F.xxhash64("event_type", "value"), F.lit(8))), path, sep="\t", header=False, partition_by=["file"])
    raw = spark.read.schema("event_type string, value double").option("sep", "\t").csv(path) \
        .withColumn("file", F.regexp_extract(F.col("_metadata.file_path"), r"file=([0-9.]+)", 1))
    channels = vocabulary(raw, "event_type")
    # one aggregate: mean |value| of every channel per file; then a lineage cut, so the
    # fits below read the small per-file table instead of re-listing every file
    means = cut_lineage(raw.groupBy("file").agg(
        *[F.coalesce(F.avg(F.when(F.col("event_type") == c, F.abs("value"))), F.lit(0.0)).alias(c) for c in channels])
        .select(F.to_timestamp_ntz("file", F.lit("yyyy.MM.dd.HH.mm.ss")).alias("ts"), *channels))
    split = time_split(means, "ts", "2024-01-21 00:00:00")
    train = split.filter(F.col("part") == "train")
    scaled = MinMax.fit(train, channels).transform(split).withColumn("x", F.array(*[F.col(c) for c in channels]))
    res = pca_residual(scaled.filter(F.col("part") == "train"), scaled.withColumn("k", F.concat_ws("|", "ts", "part")),
                       "x", 2, "k")
    res = res.withColumn("part", F.split("k", r"\|")[1]).withColumn("ts", F.split("k", r"\|")[0])
    return anomaly_flags(res, "residual", F.col("part") == "train").drop("k")


def loan_dummies(train, test):
    """(train, test) with dummies of the text columns, each part fitted on its own and test
    aligned to train's columns."""
    cats = ["home_ownership", "purpose_cat"]
    oh = OneHot.fit(train, cats)
    cols = ["Id", "is_bad", "emp_length", "annual_inc", "zip3", "delinq_2yrs"] + oh.wide_columns()
    return (align_columns(oh.transform(train, wide=True), cols),
            align_columns(OneHot.fit(test, cats).transform(test, wide=True), cols))


@query("loan_flow")
def loan_flow_q(spark, sf):
    """Loan default: typed TSV read with a per-column NULL token and read-time
    converters (first three zip digits, m/d/yy dates), the fill/clip/cast rule table,
    two date windows sharing a boundary day, dummies fitted on train and aligned on
    test, boosted trees, mean accuracy on test."""
    path = scratch_path(spark, "loans-tsv")
    c = table(spark, sf, "customer")
    o = table(spark, sf, "orders")
    rows = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("Id"), (F.col("o_orderstatus") == "F").cast("long").alias("is_bad"),
        F.when(F.col("o_orderkey") % 9 == 0, F.lit("na")).otherwise((F.col("c_nationkey") % 13).cast("string")).alias("emp_length"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("NONE")).otherwise(F.col("c_mktsegment")).alias("home_ownership"),
        (F.col("o_totalprice") / 2).alias("annual_inc"),
        F.floor(F.abs(F.col("c_acctbal")) * 100).cast("bigint").cast("string").alias("zip_code"),
        F.date_format("o_orderdate", "M/d/yy").alias("earliest_cr_line"),
        (F.col("o_custkey") % 6).cast("double").alias("delinq_2yrs"),
        F.concat_ws(" ", F.lower("c_mktsegment"), F.when(F.col("o_orderkey") % 4 == 0, F.lit("small business"))
                    .otherwise(F.col("o_orderpriority"))).alias("purpose_cat"))
    write_delimited(rows, path, sep="\t")
    schema = ("Id bigint, is_bad bigint, emp_length double, home_ownership string, annual_inc double, "
              "zip_code string, earliest_cr_line string, delinq_2yrs double, purpose_cat string")
    lcd = read_delimited(spark, path, schema, sep="\t", null_tokens={"emp_length": "na"})
    lcd = lcd.withColumn("zip3", zip_prefix("zip_code")).withColumn("cr_date", two_digit_year_date("earliest_cr_line"))
    lcd = lcd.withColumn("purpose_cat", suffix_collapse("purpose_cat", "small business"))
    lcd = apply_rules(lcd, {k: v for k, v in LOAN_RULES.items() if k in lcd.columns})
    parts = cut_lineage(date_range_split(lcd, "cr_date", [("train", "1995-01-01", "1999-12-31"),
                                                           ("test", "1999-12-31", "2001-12-31")]), FIT_ROWS)
    train, test = parts.filter(F.col("part") == "train"), parts.filter(F.col("part") == "test")
    train_d, test_d = loan_dummies(train, test)
    feats = [c for c in train_d.columns if c not in ("Id", "is_bad")]
    model = fit_gbt(train_d.withColumn("label", F.col("is_bad").cast("double")), "label", feats, maxIter=10, maxDepth=3)
    pred = model.transform(test_d)
    return pred.agg(F.count(F.lit(1)).alias("n_test"),
                    F.avg((F.col("prediction") == F.col("is_bad")).cast("double")).alias("accuracy"))


@query("income_flow")
def income_flow_q(spark, sf):
    """Income bracket: ' ?' tokens to NULL in every string column, mode imputation,
    canonical label text, label encoding fitted on train, class-weighted boosted
    trees, ROC AUC and confusion counts on test."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer")
    raw = o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", F.col("c_acctbal").alias("capital_gain"), (F.col("o_totalprice") / 1000).alias("hours"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit(" ?")).otherwise(F.concat(F.lit(" "), F.col("c_mktsegment"))).alias("workclass"),
        F.when(F.col("o_orderkey") % 13 == 0, F.lit(" ?")).otherwise(F.concat(F.lit(" "), F.col("o_orderpriority"))).alias("occupation"),
        F.concat(F.lit(" "), F.col("o_orderstatus"), F.when(F.col("o_orderkey") % 2 == 0, F.lit(".")).otherwise(F.lit(""))).alias("income"))
    clean = impute_mode(tokens_to_null(raw, [" ?"]), ["workclass", "occupation"])
    clean = clean.withColumn("label", (F.btrim("income", F.lit(". ")) == "F").cast("double"))
    split = cut_lineage(mod_split(clean, "o_orderkey", 5), FIT_ROWS)
    train = split.filter(F.col("part") == "train")
    enc = LabelEncode.fit(train, ["workclass", "occupation"])
    coded = enc.transform(split)
    feats = ["capital_gain", "hours", "workclass", "occupation"]
    weighted = class_weight(coded.filter(F.col("part") == "train"), "label")  # majority : minority
    model = fit_gbt(weighted, "label", feats, weight="weight", maxIter=10, maxDepth=3)
    # scored once: the AUC and the rates below read the stored scores
    test = cut_lineage(positive_probability(model.transform(coded.filter(F.col("part") == "test"))).select("label", "score"))
    auc = roc_auc(test, "label", "score").first()["auc"]  # one number
    return binary_metrics(test, "label", "score", 0.5).withColumn("auc", F.lit(auc))


@query("retail_flow")
def retail_flow_q(spark, sf):
    """Retail next category (the per-user flow): the age-band CASE code (unknown
    bands -> 0), MOD(user, 5) train/test split, each user's first order as the one-hot
    target and the count vector of the other orders' categories as features, a
    multiclass forest, subset accuracy of predicted vs target vectors on test users."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    # stand-in age text per customer: the seven band labels and one unlisted value
    bands = F.array(*[F.lit(b) for b in list(AGE_BAND_CODES) + ["unknown"]])
    ages = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.element_at(bands, (F.col("c_nationkey") % 8 + 1).cast("int")).alias("age"))
    o = o.join(ages, "o_custkey").withColumn("age_code", ordinal_case("age", AGE_BAND_CODES, default_cast=False, default=0))
    target, rest = split_first(o, "o_custkey", ["o_orderdate", "o_orderkey"])
    vocab = vocabulary(o, "o_orderpriority")
    feats = count_vector(rest, "o_custkey", "o_orderpriority", vocab, "n_")
    codes = group_count(rest, ["o_custkey"], "n_orders")
    idx = {v: i for i, v in enumerate(vocab)}
    tgt = target.select("o_custkey", map_values("o_orderpriority", idx).cast("double").alias("label"), "age_code")
    rows = cut_lineage(mod_split(feats.join(codes, "o_custkey").join(tgt, "o_custkey"), "o_custkey", 5), FIT_ROWS)
    fcols = [f"n_{v}" for v in vocab] + ["n_orders", "age_code"]
    model = fit_rf(rows.filter(F.col("part") == "train"), "label", fcols, num_trees=20)
    pred = model.transform(rows.filter(F.col("part") == "test"))
    onehot = lambda c: F.array(*[(F.col(c) == F.lit(float(i))).cast("int") for i in range(len(vocab))])
    return exact_match_accuracy(pred.select(onehot("label").alias("t"), onehot("prediction").alias("p")), "t", "p")

