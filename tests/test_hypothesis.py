import math

import pytest
from pyspark.sql import functions as F

from statframe.functions import special
from statframe.operators import hypothesis as H


def one(df):
    return df.collect()[0]


def cats(spark, values, name="observed"):
    return spark.createDataFrame([(str(i), float(v)) for i, v in enumerate(values)],
                                 f"category string, {name} double")


def test_f8_uniform(spark):
    r = one(H.chisq_gof(cats(spark, [10, 20, 30])))
    assert r["statistic"] == 10.0 and r["degrees_of_freedom"] == 2
    assert math.isclose(r["p_value"], 0.006737946999085476, rel_tol=1e-12)


def test_f9_zero_expected(spark):
    r = one(H.chisq_gof(cats(spark, [1, 2]), cats(spark, [0, 3], "expected")))
    assert r["statistic"] == float("inf") and r["p_value"] == 0.0 and r["degrees_of_freedom"] == 1


def test_f10_f11_errors(spark):
    with pytest.raises(ValueError, match="0.0 values in both"):
        H.chisq_gof(cats(spark, [0, 2]), cats(spark, [0, 3], "expected"))
    with pytest.raises(ValueError, match="degrees of freedom 0"):
        H.chisq_gof(cats(spark, [10]))
    with pytest.raises(ValueError, match="negative"):
        H.chisq_gof(cats(spark, [-1, 2]))
    with pytest.raises(ValueError, match="same size"):
        H.chisq_gof(cats(spark, [1, 2, 3]), cats(spark, [1, 2], "expected"))


def test_f12_independence(spark):
    # 2 x 3 column-major 10, 20, 30, 5, 15, 25 -> rows r0 = (10, 30, 15), r1 = (20, 5, 25)
    vals = [10, 20, 30, 5, 15, 25]
    t = spark.createDataFrame([(i % 2, i // 2, float(v)) for i, v in enumerate(vals)],
                              "row int, col int, count double")
    r = one(H.chisq_independence(t))
    assert math.isclose(r["statistic"], 23.50568181818182, rel_tol=1e-12)
    assert r["degrees_of_freedom"] == 2
    assert math.isclose(r["p_value"], 7.866943778855884e-06, rel_tol=1e-9)


def test_f13_single_row_table(spark):
    t = spark.createDataFrame([(0, j, float(v)) for j, v in enumerate([10, 20, 30])],
                              "row int, col int, count double")
    r = one(H.chisq_independence(t))
    assert (r["statistic"], r["degrees_of_freedom"], r["p_value"]) == (0.0, 0, 1.0)


def test_independence_zero_margin_error(spark):
    t = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (1, 0, 0.0), (1, 1, 0.0)],
                              "row int, col int, count double")
    with pytest.raises(Exception, match="0 sum in a row"):
        H.chisq_independence(t).collect()


def test_f14_feature_tests(spark):
    df = spark.createDataFrame([(0.0, 1.0, 0.0), (1.0, 2.0, -1.0), (1.0, 2.0, 0.0)],
                               "label double, f0 double, f1 double")
    res = {r["feature_index"]: r for r in H.chisq_features(df, "label", ["f0", "f1"]).collect()}
    assert math.isclose(res[0]["statistic"], 3.0) and res[0]["degrees_of_freedom"] == 1
    assert math.isclose(res[0]["p_value"], 0.0832645167, rel_tol=1e-9)
    assert math.isclose(res[1]["statistic"], 0.75) and res[1]["degrees_of_freedom"] == 1
    assert math.isclose(res[1]["p_value"], 0.3864762308, rel_tol=1e-9)


def test_features_match_builtin(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(
        (F.col("l_linestatus") == "F").cast("double").alias("label"), "l_tax", "l_discount")
    vec = VectorAssembler(inputCols=["l_tax", "l_discount"], outputCol="v").transform(li)
    ref = ChiSquareTest.test(vec, "v", "label").collect()[0]
    ours = {r["feature_index"]: r for r in
            H.chisq_features(li, "label", ["l_tax", "l_discount"]).collect()}
    for i in range(2):
        assert math.isclose(ours[i]["statistic"], ref["statistics"][i], rel_tol=1e-9)
        assert ours[i]["degrees_of_freedom"] == ref["degreesOfFreedom"][i]
        assert math.isclose(ours[i]["p_value"], ref["pValues"][i], rel_tol=1e-7, abs_tol=1e-12)


def test_f15_ks_std_normal(spark):
    df = spark.createDataFrame([(i / 10,) for i in range(-10, 12)], "x double")
    r = one(H.ks_test(df, "x"))
    assert math.isclose(r["statistic"], 0.15865525393145702, rel_tol=1e-12)
    assert math.isclose(r["p_value"], 0.5824857702484245, rel_tol=1e-10)
    assert r["degrees_of_freedom"] == 0


def test_f16_ks_events_normal(spark):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    r = one(H.ks_test(ev, "value", "norm", 50.0, 50.0))
    assert math.isclose(r["statistic"], 0.15870365291577537, rel_tol=1e-9)
    assert r["p_value"] < 1e-9


def test_ks_matches_builtin_pelz_good(spark):
    import numpy as np
    from pyspark.mllib.stat import Statistics

    x = np.random.default_rng(7).normal(0.1, 1.0, 2000).tolist()
    ref = Statistics.kolmogorovSmirnovTest(spark.sparkContext.parallelize(x, 4), "norm", 0.0, 1.0)
    r = one(H.ks_test(spark.createDataFrame([(v,) for v in x], "x double"), "x"))
    assert math.isclose(r["statistic"], ref.statistic, rel_tol=1e-12)
    assert math.isclose(r["p_value"], ref.pValue, rel_tol=1e-8, abs_tol=1e-12)


def test_ks_named_distribution_checks(spark):
    df = spark.createDataFrame([(0.0,)], "x double")
    with pytest.raises(ValueError, match="norm"):
        H.ks_test(df, "x", "expon")
    with pytest.raises(ValueError, match="mean and standard deviation"):
        H.ks_test(df, "x", "norm", 1.0)


def test_f26_result_text(spark):
    res = spark.createDataFrame([(p, 1, 1.0, "pearson", "h0.") for p in
                                 [0.01, 0.05, 0.1, 0.2, float("nan")]],
                                "p_value double, degrees_of_freedom int, statistic double, "
                                "method string, null_hypothesis string")
    got = [r["presumption"].split(" presumption")[0] for r in
           H.explain(res).orderBy(F.col("p_value").asc_nulls_last()).collect()]
    assert got == ["Very strong", "Strong", "Low", "No", "No"]


def test_special_functions():
    assert math.isclose(special.chi2_sf(10.0, 2.0), math.exp(-5), rel_tol=1e-14)
    assert math.isclose(special.norm_cdf(1.0), 0.8413447460685429, rel_tol=1e-15)
    assert special.ks_cdf(0.01, 10) == 0.0
    assert math.isclose(special.t_two_sided_p(0.0, 5.0), 1.0)


def test_vectorised_normal_cdf_matches_erfc():
    import numpy as np

    z = np.concatenate([np.linspace(-45, 45, 4001), np.random.default_rng(5).normal(0, 3, 5000)])
    got = special.std_norm_cdf_np(z)
    want = np.array([special.norm_cdf(v) for v in z])
    assert np.abs(got - want).max() < 2e-15


@pytest.mark.parametrize("observed,expected", [([0, 0, 0], None), ([0, 0], [1, 1]), ([0, 0], [2, 5])])
def test_nothing_observed_is_no_evidence(spark, observed, expected):
    """Against positive expectations a total of 0 gives NaN, as the unscaled expectation decides."""
    r = one(H.chisq_gof(cats(spark, observed), None if expected is None else
                        cats(spark, expected, "expected")))
    assert math.isnan(r["statistic"]) and math.isnan(r["p_value"])
    assert "No presumption" in one(H.explain(H.chisq_gof(cats(spark, observed))))["presumption"]


def test_nothing_expected(spark):
    r = one(H.chisq_gof(cats(spark, [1, 2]), cats(spark, [0, 0], "expected")))
    assert r["statistic"] == float("inf") and r["p_value"] == 0.0
    with pytest.raises(ValueError, match="both observed and expected"):
        H.chisq_gof(cats(spark, [0, 2]), cats(spark, [0, 0], "expected"))


def test_infinite_and_nan_counts(spark):
    inf, nan = float("inf"), float("nan")
    r = one(H.chisq_gof(cats(spark, [inf, 2])))
    assert math.isnan(r["statistic"]) and math.isnan(r["p_value"])
    for bad in (inf, nan):
        table = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("b", "x", bad), ("b", "y", 4.0)],
                                      "row string, col string, count double")
        r = one(H.chisq_independence(table))
        assert math.isnan(r["statistic"]) and math.isnan(r["p_value"])


def test_features_come_in_order(spark):
    df = spark.range(60).select((F.col("id") % 2).alias("y"), F.array(*[
        F.pmod(F.xxhash64("id", F.lit(j)), F.lit(3)).cast("double") for j in range(12)]).alias("v"))
    got = [(r["feature_index"], r["feature"]) for r in H.chisq_features(df, "y", "v").collect()]
    assert got == [(j, f"v[{j}]") for j in range(12)]


def test_too_many_categories_end_before_the_shuffle(tmp_path):
    """A feature of 10^7 values fails in a session of its own, whose event log shows what was shuffled."""
    import json
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    code = f"""
import sys
sys.path.insert(0, {str(root)!r})
from pyspark.sql import SparkSession
SparkSession.builder.master("local[4]").config("spark.eventLog.enabled", "true").config(
    "spark.eventLog.dir", "file://{tmp_path}").config("spark.eventLog.compress", "false").config(
    "spark.ui.enabled", "false").config("spark.driver.memory", "2g").getOrCreate()
from statframe.operators import hypothesis as H
from statframe.session import local_session
spark = local_session(4, 8)
df = spark.range(10**7).selectExpr("id % 2 as y", "id % 3 as few", "id as many")
try:
    H.chisq_features(df, "y", ["few", "many"])
except ValueError as e:
    print(e)
spark.stop()
"""
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert got.stdout.strip() == "feature 'many' has more than 10000 distinct values", got.stderr[-2000:]
    log = [f for f in tmp_path.rglob("*") if f.is_file() and f.name.startswith(("local-", "events_"))]
    rows = 0
    for f in log:
        for line in f.read_text().splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerTaskEnd":
                rows += e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Records Written"]
    assert log and rows < 100


def test_a_category_too_many_in_no_single_task(spark):
    """Every task stays below the cap; the merged sets do not."""
    df = spark.range(0, 400, 1, 8).selectExpr("id % 2 as y", "id as v")
    with pytest.raises(ValueError, match="feature 'v' has more than 100"):
        H.chisq_features(df, "y", ["v"], max_categories=100)
    assert H.chisq_features(df, "y", ["v"], max_categories=400).count() == 1


def test_ks_is_one_range_exchange(spark):
    """One range exchange, one row out of each of its partitions, no other data shuffle."""
    df = spark.range(5000).select((F.col("id") % 997).cast("double").alias("x"))
    plan = H.ks_test(df, "x", lambda c: c / 1000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning" not in plan


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_ks_partial_extremes(spark, parts):
    """Against the sorted rows, with ties over a third of them, at several partition counts."""
    import numpy as np

    rng = np.random.default_rng(parts)
    x = np.concatenate([rng.exponential(50, 400), np.full(200, 20.0), rng.integers(0, 9, 100)])
    df = spark.createDataFrame([(float(v),) for v in rng.permutation(x)], "x double").repartition(parts)
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        r = one(H.ks_test(df, "x", lambda c: 1 - F.exp(-c / 50.0)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    s, n = np.sort(x), len(x)
    f = 1 - np.exp(-s / 50.0)
    want = max((f - np.arange(n) / n).max(), ((np.arange(n) + 1) / n - f).max())
    assert r["statistic"] == pytest.approx(want, abs=1e-14)
