"""Hand-computed cases the given tables never hold: NULL groups, ties, NaN, one class, odd names."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from kestrel.operators.metrics import roc_auc
from kestrel.operators.ordering import rank_within
from kestrel.operators.profile import describe, exact_quantiles, histogram
from kestrel.operators.project import one_vs_rest, zero_indicator
from kestrel.operators.reshape import melt_long, one_hot_columns, pivot_counts, pivot_values, vocabulary
from kestrel.operators.split import random_split, sample_n, stratified_split
from kestrel.operators.timeseries import split_first
from kestrel.sources.files import read_delimited
from kestrel.sources.text import kv_map


@pytest.mark.parametrize("n", [60, 70])
def test_pivot_names_with_dots_at_any_width(spark, n):
    df = spark.createDataFrame([(1, f"a.{i}`x") for i in range(n)] + [(2, "a.0`x")], "k int, v string")
    vocab = vocabulary(df, "v")
    out = pivot_counts(df, "k", "v", vocab, fill=0)
    assert out.columns == ["k", *vocab]
    rows = {r[0]: list(r)[1:] for r in out.collect()}
    assert sum(rows[1]) == n and sum(rows[2]) == 1
    long = melt_long(pivot_counts(df, "k", "v", vocab), "k").filter("value is not null")
    assert long.count() == n + 1


def test_pivot_names_of_numbers(spark):
    df = spark.createDataFrame([(1, 1e-7, 5), (1, 2.5, 6)], "k int, v double, x int")
    assert pivot_values(df, "k", "v", "x", [1e-7, 2.5]).columns == ["k", "1e-07", "2.5"]


def test_row_equal_to_a_column_name_stays(spark, tmp_path):
    path = f"file://{tmp_path}/c"
    df = spark.createDataFrame([("name", 1), ("x", 2)], "name string, n int")
    df.coalesce(1).write.option("header", True).csv(path)
    assert read_delimited(spark, path, "name string, n int").count() == 2
    assert read_delimited(spark, path, "name string, n int", drop_repeated_headers=True).count() == 1


def test_null_group_is_kept(spark):
    df = spark.createDataFrame([(None if i % 3 == 0 else "g", i) for i in range(30)], "g string, i int")
    out = rank_within(df, "g", ["i"])
    assert out.count() == 30
    assert {r.pos_n for r in out.filter("g is null").collect()} == {10}
    assert stratified_split(df, "g", "i", [("train", 0.5), ("test", 0.5)]).count() == 30


def test_kv_map_keeps_all_after_the_first_separator(spark):
    df = spark.createDataFrame([("a\tb\tc\nk\t1\nk\t2\nalone\n",), ("",)], "t string")
    assert [r[0] for r in df.select(kv_map(F.col("t"))).collect()] == [{"a": "b\tc", "k": "2", "alone": "alone"}, {}]


def test_null_flags_are_zero(spark):
    df = spark.createDataFrame([(None,), ("a",)], "c string")
    assert [tuple(r) for r in one_vs_rest(df, "c", ["a", "b"]).collect()] == [(None, 0, 0), ("a", 1, 0)]
    assert [tuple(r) for r in df.select(*one_hot_columns("c", ["a"])).collect()] == [(0,), (1,)]
    nums = spark.createDataFrame([(None,), (0.0,), (2.0,)], "x double")
    assert [r[0] for r in nums.select(zero_indicator("x")).collect()] == [0, 1, 0]


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.9)], "y int, s double")
    assert roc_auc(df, "y", "s").first()["auc"] is None


def test_split_first_with_nulls_and_ties(spark):
    rows = [("u", None, 1), ("u", 5, 2), ("u", 5, 3), ("v", None, 9), ("v", 2, 8), (None, 1, 1), (None, 2, 2), ("w", 1, 1)]
    target, rest = split_first(spark.createDataFrame(rows, "k string, o int, x int"), "k", ["o"])
    assert sorted(map(str, map(tuple, target.collect()))) == sorted(map(str, [("u", 5, 2), ("v", 2, 8), (None, 1, 1)]))
    assert sorted(map(str, map(tuple, rest.collect()))) == sorted(
        map(str, [("u", None, 1), ("u", 5, 3), ("v", None, 9), (None, 2, 2)]))
    twice = spark.createDataFrame([("u", 1, 1)] * 3, "k string, o int, x int")
    target, rest = split_first(twice, "k", ["o"])
    assert rest.count() == 2 and target.distinct().count() == 1


def test_histogram_with_nan_and_nulls(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (0.0,), (10.0,)], "x double")
    rows = histogram(df, "x", 5).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [1, 0, 0, 0, 1] and rows[0]["right"] == 2.0
    none = histogram(df.filter("x is null"), "x", 3).collect()
    assert [r["count"] for r in none] == [0, 0, 0]


def test_quantiles_of_a_tied_column(spark):
    df = spark.range(20_000).select(F.when(F.col("id") < 19_000, 1.0).otherwise(F.col("id").cast("double")).alias("x"))
    got = {r.q: r.value for r in exact_quantiles(df, ["x"], [0.0, 0.5, 0.96, 1.0]).collect()}
    assert got == {0.0: 1.0, 0.5: 1.0, 0.96: pytest.approx(0.96 * 19_999), 1.0: 19_999.0}
    d = describe(spark.createDataFrame([Row(a=1.0, b=2), Row(a=None, b=4)], "a double, b int"), ["a", "b"]).collect()
    assert {r.column: (r["count"], r.p50, r.max) for r in d} == {"a": (1, 1.0, 1.0), "b": (2, 3.0, 4.0)}


def test_samples_do_not_depend_on_partitioning(spark):
    df = spark.range(1000)
    a = sorted(r.id for r in sample_n(df, 20, 3).collect())
    assert a == sorted(r.id for r in sample_n(df.repartition(7), 20, 3).collect())
    parts = random_split(df, [0.7, 0.3], 5)
    assert sum(p.count() for p in parts) == 1000 and 600 < parts[0].count() < 800
    assert parts[0].intersect(parts[1]).isEmpty()


def test_scratch_dir_refuses_a_cluster_without_shared_folder():
    from kestrel.session import scratch_dir

    class Empty:
        def isEmpty(self):
            return True

    class Context:
        master = "spark://host:7077"

        class _jsc:
            @staticmethod
            def sc():
                class S:
                    @staticmethod
                    def getCheckpointDir():
                        return Empty()
                return S

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(_key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(Session)
