"""Rules that differ between libraries, checked on tiny literal frames (T1, T2, T5,
C2, A19, F9, F10, F16, P11, F29, E11)."""

import math

import numpy as np
from pyspark.sql import functions as F

from kestrel.functions.arrays import center_fit
from kestrel.functions.dates import expand_year, two_digit_year_date
from kestrel.operators.clean import Rule, apply_rules, clip_upper, impute_mode
from kestrel.operators.features import WORK_HOUR_EDGES, MinMax, OneHot, RightClosedBins, Standardize
from kestrel.operators.aggregate import mode_value
from kestrel.operators.profile import moments
from kestrel.operators.project import ordinal_case


def test_minmax_constant_column_is_zero_and_test_may_leave_range(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, c double")
    test = spark.createDataFrame([(5.0, 5.0)], "a double, c double")
    mm = MinMax.fit(train, ["a", "c"])
    r = mm.transform(test).first()
    assert r["a"] == 2.0 and r["c"] == 0.0


def test_standardize_uses_population_sd(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    st = Standardize.fit(df, ["x"])
    got = [r["x"] for r in st.transform(df).orderBy("x").collect()]
    x = np.array([1, 2, 3, 4.0])
    assert np.allclose(got, (x - x.mean()) / x.std(ddof=0))


def test_right_closed_bins(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.5,), (50.0,), (99.0,), (None,)], "h double")
    b = RightClosedBins(WORK_HOUR_EDGES)
    got = [(r["i"], r["l"]) for r in df.select(b.index("h").alias("i"), b.label("h").alias("l")).collect()]
    assert got == [(None, None), (0, "(0.0, 10.0]"), (1, "(10.0, 20.0]"), (4, "(40.0, 50.0]"),
                   (5, "(50.0, inf]"), (None, None)]


def test_clip_keeps_null_and_rule_chain(spark):
    df = spark.createDataFrame([(None,), (3.0,), (20.0,)], "e double")
    assert [r[0] for r in df.select(clip_upper("e", 10)).collect()] == [None, 3.0, 10.0]
    out = apply_rules(df, {"e": Rule(fill=1, clip_upper=10, cast="bigint")})
    assert [r[0] for r in out.collect()] == [1, 3, 10]


def test_mode_ties_take_smallest_numeric_value(spark):
    df = spark.createDataFrame([(9,), (10,), (10,), (9,), (None,)], "v int")
    assert mode_value(df, "v").first()["mode"] == 9
    filled = impute_mode(df, ["v"]).collect()
    assert sorted(r[0] for r in filled) == [9, 9, 9, 10, 10]


def test_two_digit_year_pivot(spark):
    df = spark.createDataFrame([("1/2/68",), ("3/4/07",), ("12/31/20",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(two_digit_year_date("t")).collect()]
    assert [str(g) if g else None for g in got] == ["1968-01-02", "2007-03-04", "2020-12-31", None, None]


def test_expand_year(spark):
    df = spark.createDataFrame([("Jan-01",), ("Dec-99",), ("May-97",)], "t string")
    assert [r[0] for r in df.select(expand_year("t", 97)).collect()] == ["Jan-2001", "Dec-1999", "May-97"]


def test_round_half_up_vs_half_even(spark):
    df = spark.createDataFrame([(2.5,), (0.125,)], "x double")
    r = df.select(F.round("x", 0).alias("a"), F.bround("x", 0).alias("b"), F.bround("x", 2).alias("c")).collect()
    assert (r[0]["a"], r[0]["b"]) == (3.0, 2.0)
    assert r[1]["c"] == 0.12


def test_ordinal_case_try_cast(spark):
    df = spark.createDataFrame([("4+",), ("2",), ("x",)], "s string")
    assert [r[0] for r in df.select(ordinal_case("s", {"4+": 4})).collect()] == [4, 2, None]


def test_center_fit_matches_numpy(spark):
    a = [float(x) for x in range(7)]
    df = spark.createDataFrame([(a,)], "a array<float>")
    r = df.select(center_fit("a", 4).alias("c"), center_fit("a", 10).alias("p")).first()
    assert r["c"] == [1.0, 2.0, 3.0, 4.0]
    assert r["p"] == [0.0] + a + [0.0, 0.0]


def test_moments_match_population_formulas(spark):
    x = np.array([1.0, 2.0, 2.0, 3.0, 9.0])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    r = moments(df, "x").first()
    m = x.mean()
    m2, m3, m4 = ((x - m) ** 2).mean(), ((x - m) ** 3).mean(), ((x - m) ** 4).mean()
    assert math.isclose(r["variance"], x.var(ddof=1))
    assert math.isclose(r["skewness"], m3 / m2 ** 1.5)
    assert math.isclose(r["kurtosis"], m4 / m2 ** 2 - 3)


def test_onehot_unseen_is_all_zero(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    test = spark.createDataFrame([("b",), ("z",), (None,)], "c string")
    got = [r["c_onehot"] for r in OneHot.fit(train, ["c"]).transform(test).collect()]
    assert got == [[0.0, 1.0], [0.0, 0.0], [0.0, 0.0]]


def test_trial_table_array_document(spark):
    from kestrel.operators.metrics import best_trial, trial_table
    doc = ('{"trials": [{"trialId": "1", "hyperparameters": {"max_depth": "3"}, '
           '"finalMetric": {"trainingStep": 1000, "objectiveValue": 0.82}}, '
           '{"trialId": "2", "hyperparameters": {"max_depth": "7"}, '
           '"finalMetric": {"trainingStep": 1000, "objectiveValue": 0.92}}]}')
    t = trial_table(spark.createDataFrame([(doc,)], "j string"), "j", ["max_depth"], trials_path="trials")
    assert t.count() == 2
    best = best_trial(t, "objective").first()
    assert (best["trial_id"], best["max_depth"], best["objective"]) == (2, "7", 0.92)


def test_calendar_spine_between(spark):
    from kestrel.sources.spine import calendar_spine_between
    days = [str(r[0]) for r in calendar_spine_between(spark, "2024-02-27", "2024-03-01").collect()]
    assert days == ["2024-02-27", "2024-02-28", "2024-02-29", "2024-03-01"]


def test_age_band_codes(spark):
    from kestrel.plans.columns import AGE_BAND_CODES
    df = spark.createDataFrame([("0-17",), ("26-35",), ("55+",), ("unknown",)], "age string")
    got = [r[0] for r in df.select(ordinal_case("age", AGE_BAND_CODES, default_cast=False, default=0)).collect()]
    assert got == [1, 3, 7, 0]
