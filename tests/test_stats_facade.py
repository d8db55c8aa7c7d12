import math

from hypothesis import given, settings
from hypothesis import strategies as st

import statframe as sf


def test_facade_dispatch(spark):
    df = spark.createDataFrame([(1.0, 0.0, 0.0), (2.0, -1.0, 1.0), (2.0, 0.0, 1.0)],
                               "a double, b double, label double")
    assert {r["column"] for r in sf.col_stats(df, ["a", "b"]).collect()} == {"a", "b"}
    assert sf.corr(df, "a", "b").count() == 1
    assert sf.corr(df, ["a", "b"], method="spearman").count() == 4
    assert sf.chi_sq_test(df, label="label", features=["a", "b"]).count() == 2
    obs = spark.createDataFrame([("x", 10.0), ("y", 20.0), ("z", 30.0)],
                                "category string, observed double")
    assert sf.chi_sq_test(obs).collect()[0]["statistic"] == 10.0
    t = spark.createDataFrame([(0, 0, 3.0), (0, 1, 4.0), (1, 0, 5.0), (1, 1, 1.0)],
                              "r int, c int, count double")
    assert sf.chi_sq_test(t, row="r", col="c").collect()[0]["degrees_of_freedom"] == 1
    assert sf.kolmogorov_smirnov_test(df, "a").collect()[0]["degrees_of_freedom"] == 0
    assert sf.naive_bayes(df.selectExpr("label", "a"), "label", ["a"]).num_classes == 2
    assert sf.linear_regression_sgd(df, "label", ["a"], num_iterations=3).num_features == 1


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from("xy")), min_size=6, max_size=60))
def test_chi_sq_row_order_invariant_and_pvalue_bounded(spark, pairs):
    df = spark.createDataFrame(pairs, "r string, c string")
    counts = df.groupBy("r", "c").count()
    if counts.select("r").distinct().count() < 2 or counts.select("c").distinct().count() < 2:
        return
    a = sf.chi_sq_test(counts, row="r", col="c").collect()[0]
    b = sf.chi_sq_test(counts.orderBy("c", "r").repartition(3), row="r", col="c").collect()[0]
    assert math.isclose(a["statistic"], b["statistic"], rel_tol=1e-12, abs_tol=1e-12)
    assert 0.0 <= a["p_value"] <= 1.0 + 1e-12


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-5, 5, allow_nan=False), min_size=1, max_size=50))
def test_ks_statistic_bounds(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    r = sf.kolmogorov_smirnov_test(df, "x").collect()[0]
    assert 1.0 / (2 * len(xs)) - 1e-12 <= r["statistic"] <= 1.0
    assert 0.0 <= r["p_value"] <= 1.0 + 1e-12


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.floats(-10, 10), st.floats(-10, 10)), min_size=3, max_size=30))
def test_pearson_bounded(spark, pts):
    df = spark.createDataFrame(pts, "a double, b double")
    r = sf.corr(df, "a", "b").collect()[0]["corr"]
    assert math.isnan(r) or -1 - 1e-9 <= r <= 1 + 1e-9
