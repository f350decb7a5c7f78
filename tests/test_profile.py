import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions.quantiles import exact_quantiles
from riskframe.operators import compare, profile


def test_moments_fixture(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 4, 9, 20]], "x double")
    r = {x["column"]: x for x in profile.numeric_profile(df, ["x"]).collect()}["x"]
    assert r["skewness"] == pytest.approx(1.4901199696, rel=1e-9)
    assert r["kurtosis"] == pytest.approx(1.8954319322, rel=1e-9)
    assert r["var"] == pytest.approx(60.7)
    assert (r["q1"], r["median"], r["q3"]) == (2.0, 4.0, 9.0)


def test_mode_smallest_on_ties(spark):
    df = spark.createDataFrame([(float(x),) for x in [3, 3, 1, 1, 2]], "x double")
    r = profile.numeric_profile(df, ["x"]).first()
    assert r["mode"] == 1.0


def test_outlier_fixture(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100]], "x double")
    f = profile.fences(df, ["x"]).first()
    assert (f["q1"], f["q3"], f["lower"], f["upper"], f["median"]) == (2.0, 4.0, -1.0, 7.0, 3.0)
    assert profile.numeric_profile(df, ["x"]).first()["outlier_count"] == 1


def test_const_and_null_columns(spark):
    df = spark.createDataFrame([(5.0, None), (5.0, None), (5.0, None)], "a double, b double")
    nulls = {r["column"]: r["n_null"] for r in profile.null_counts(df).collect()}
    assert nulls == {"a": 0, "b": 3}
    d = {r["column"]: r for r in profile.describe(df, ["a"]).collect()}
    assert d["a"]["std"] == 0.0 and d["a"]["p50"] == 5.0


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a")] * 3 + [(2, "b"), (3, None)], "x int, y string")
    assert profile.duplicate_count(df).first()[0] == 2


def test_category_diff_counts_null_as_value(spark):
    a = spark.createDataFrame([("A",), ("B",), (None,)], "c string")
    b = spark.createDataFrame([("B",), ("C",)], "c string")
    got = {(r["value"], r["only_in"]) for r in compare.category_diff(a, b, ["c"]).collect()}
    assert got == {("A", "train"), (None, "train"), ("C", "test")}


@pytest.mark.parametrize("enumerate_rows", [100000, 50])
def test_exact_quantiles_match_numpy(spark, enumerate_rows):
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=3000), np.full(800, 0.25), rng.integers(0, 5, 500)])
    rows = [("g1", float(v)) for v in vals] + [("g2", float(v)) for v in vals[:7]]
    df = spark.createDataFrame(rows, "column string, value double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    res = exact_quantiles(df, probs, accuracy=100, enumerate_rows=enumerate_rows)
    for g, v in (("g1", vals), ("g2", vals[:7])):
        for p in probs:
            assert res[g][p] == pytest.approx(float(np.quantile(v, p)), abs=1e-12)


def test_histogram_bins_and_closed_last(spark):
    df = spark.createDataFrame([(float(x),) for x in range(10)], "x double")
    h = profile.histogram(df, ["x"], bins=3).orderBy("bin").collect()
    assert [r["count"] for r in h] == [3, 3, 4]


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "y int")
    w = {r["y"]: r["weight"] for r in profile.class_weights_balanced(df, "y").collect()}
    assert w[0] == pytest.approx(10 / 18) and w[1] == pytest.approx(5.0)
    assert profile.balance_ratio(df, "y").first()[0] == 9.0


def test_top_categories_tie_break(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "s string")
    top = profile.top_categories(df, 2, ["s"]).orderBy("rank").collect()
    assert [(r["value"], r["count"]) for r in top] == [("c", 2), ("a", 1)]


def test_correlation_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, None), (4.0, 8.0)], "a double, b double")
    r = profile.correlation_matrix(df, ["a", "b"]).first()
    a, b = np.array([1.0, 2.0, 4.0]), np.array([2.0, 4.1, 8.0])
    assert r["corr"] == pytest.approx(float(np.corrcoef(a, b)[0, 1]))


def test_nan_is_missing_and_null_columns_keep_their_bins(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (float("nan"), None), (3.0, None)], "x double, none double")
    r = {r["column"]: r for r in profile.describe(df, ["x"]).collect()}["x"]
    assert (r["count"], r["mean"], r["p50"], r["max"]) == (3, 2.0, 2.0, 3.0)
    bins = profile.histogram(df, ["x", "none"], bins=4).collect()
    assert sorted((b["column"], b["count"]) for b in bins) == [("none", 0)] * 4 + [("x", 0), ("x", 1), ("x", 1), ("x", 1)]
    assert all(b["lower"] is None for b in bins if b["column"] == "none")
