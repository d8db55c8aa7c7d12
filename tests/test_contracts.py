"""Narrow and wide calls, small and large models, columns and arrays: the same results and the
same errors."""

import math
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from statframe.operators import bayes as NB
from statframe.operators import correlation as C
from statframe.operators import gaussian as G
from statframe.operators import hypothesis as H
from statframe.operators import linear as LR
from statframe.operators import summary as S
from statframe.session import scratch_path
from statframe.sources import models as MD
from statframe.streaming import abtest as AB
from statframe.streaming import summary as SS

INF = float("inf")


def wide(spark, rows, d):
    """``rows`` in columns c0.., repeated to d columns."""
    k = len(rows[0]) if rows else 1
    cols = [f"c{i}" for i in range(d)]
    schema = ", ".join(f"{c} double" for c in cols)
    return spark.createDataFrame([tuple(r[i % k] for i in range(d)) for r in rows], schema), cols


def by_column(df):
    return {r["column"]: r for r in df.collect()}


@pytest.mark.parametrize("weight", [None, "c1"])
def test_summary_of_infinities(spark, weight):
    rows = [(INF, 2.0), (2.0, 3.0), (-INF, 1.0), (0.0, 1.0)]
    narrow = by_column(S.col_summary(*wide(spark, rows, 2), weight=weight))["c0"]
    many = by_column(S.col_summary(*wide(spark, rows, 30), weight=weight))["c0"]
    assert (many["max"], many["min"], many["num_nonzeros"]) == (INF, -INF, narrow["num_nonzeros"])
    assert (narrow["max"], narrow["min"]) == (INF, -INF)


@pytest.mark.parametrize("weight", [None, "c1"])
@pytest.mark.parametrize("d", [2, 30])
def test_summary_of_nothing(spark, d, weight):
    df, cols = wide(spark, [(1.0, 1.0)], d)
    with pytest.raises(Exception, match="empty input"):
        S.col_summary(df.filter("c0 > 5"), cols, weight=weight).collect()


@pytest.mark.parametrize("d,group", [(2, []), (30, []), (2, ["g"]), (30, ["g"])])
def test_weighted_summary_far_from_zero(spark, d, group):
    """One pass, hot group included, against numpy in high precision."""
    rng = np.random.default_rng(0)
    x = 1e6 + rng.normal(0, 2, (400, 2))
    w = rng.integers(0, 4, 400).astype(float)
    g = np.where(np.arange(400) % 3 == 0, "hot", [f"g{i % 7}" for i in range(400)])
    df, cols = wide(spark, [tuple(map(float, r)) for r in x], d)
    ids = df.withColumn("n", F.monotonically_increasing_id())
    extra = spark.createDataFrame([(i, float(a), str(b)) for i, (a, b) in enumerate(zip(w, g))],
                                  "n2 long, w double, g string")
    data = ids.coalesce(1).withColumn("n", F.monotonically_increasing_id()).join(
        extra, F.col("n") == F.col("n2"))
    order = [tuple(r) for r in data.select("c0", "w", "g").collect()]
    got = S.col_summary(data, cols, weight="w", group_by=group).filter("column = 'c0'").collect()
    for r in got:
        own = [(a, b) for a, b, k in order if b > 0 and (not group or k == r["g"])]
        a, b = np.array(own, dtype=np.longdouble).T
        mean = (a * b).sum() / b.sum()
        m2 = (b * (a - mean) ** 2).sum()
        denom = b.sum() - (b * b).sum() / b.sum()
        assert r["mean"] == pytest.approx(float(mean), rel=1e-12)
        if denom > 0:
            assert r["variance"] == pytest.approx(float(m2 / denom), rel=1e-8)


def test_sparse_summary_of_a_stated_width(spark):
    cells = spark.createDataFrame([(0, 0, 1.0), (1, 0, 3.0), (1, 2, -2.0)],
                                  "row_id long, idx int, value double")
    got = by_column(S.sparse_summary(cells, width=4))
    assert set(got) == {f"x[{i}]" for i in range(4)}
    for empty in ("x[1]", "x[3]"):
        r = got[empty]
        assert (r["count"], r["mean"], r["variance"], r["max"], r["min"]) == (2, 0, 0, 0, 0)
    assert got["x[2]"]["mean"] == -1 and got["x[0]"]["mean"] == 2
    with pytest.raises(Exception, match="outside"):
        S.sparse_summary(cells, width=2).collect()


@pytest.mark.parametrize("d", [3, 12])
def test_covariance_of_nothing_is_an_error(spark, d):
    df, cols = wide(spark, [(1.0, 2.0, 3.0)], d)
    with pytest.raises(Exception, match="row"):
        C.cov_matrix(df.filter("c0 > 5"), cols).collect()


def test_covariance_narrow_equals_wide(spark):
    rng = np.random.default_rng(1)
    rows = [tuple(map(float, r)) for r in rng.normal(5, 2, (200, 3))]
    a = {(r["i"], r["j"]): r["cov"] for r in C.cov_matrix(*wide(spark, rows, 3)).collect()}
    b = {(r["i"], r["j"]): r["cov"] for r in C.cov_matrix(*wide(spark, rows, 20)).collect()}
    assert all(b[k] == pytest.approx(v, rel=1e-10) for k, v in a.items())


def test_correlation_registry_and_row_key(spark):
    rows = [(1, 1.0, 2.0), (2, 2.0, 1.0), (3, 3.0, 5.0), (3, 4.0, 4.0)]
    df = spark.createDataFrame(rows, "k long, x double, y double")
    C.METHODS["ones"] = lambda df, cols, nulls, dim: C.pearson(df, cols).withColumn(
        "corr", F.lit(1.0))
    try:
        assert {r["corr"] for r in C.corr(df, ["x", "y"], "ones").collect()} == {1.0}
    finally:
        del C.METHODS["ones"]
    with pytest.raises(ValueError, match="unrecognized"):
        C.corr(df, ["x", "y"], "ones")
    with pytest.raises(Exception, match="row_key"):
        C.spearman(df, ["x", "y"], row_key="k", long_form=True).collect()


def test_nan_correlations_warn(spark, caplog):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    m, _ = C.to_matrix(C.pearson(df, ["x", "y"]))
    assert np.isnan(m[0, 1]) and "NaN" in caplog.text


def test_chi_squared_keeps_large_whole_numbers_and_zeros(spark):
    big = 2 ** 53
    rows = [(big, 0.0, 0), (big + 1, -0.0, 1), (7, 0.0, 0), (big + 1, 1.0, 1)]
    df = spark.createDataFrame(rows, "a long, z double, y int")
    got = {r["feature"]: r["degrees_of_freedom"] for r in H.chisq_features(df, "y", ["a", "z"]).collect()}
    assert got == {"a": 2, "z": 1}
    alone = H.chisq_features(df, "y", ["a"]).collect()[0]
    assert alone["degrees_of_freedom"] == 2
    arrays = df.select("y", F.array("z", F.col("y").cast("double")).alias("v"))
    got = H.chisq_features(arrays, "y", "v").orderBy("feature_index").collect()
    assert [r["feature"] for r in got] == ["v[0]", "v[1]"]
    assert got[0]["statistic"] == pytest.approx(
        H.chisq_features(df, "y", ["z"]).collect()[0]["statistic"])


def test_goodness_of_fit_refuses_repeated_categories(spark):
    obs = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", 3.0)],
                                "category string, observed double")
    with pytest.raises(ValueError, match="more than once"):
        H.chisq_gof(obs)


def regression(spark, d, n=300):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (n, d))
    y = x @ np.arange(1, d + 1) / d
    cols = [f"c{i}" for i in range(d)]
    df = spark.createDataFrame([tuple(map(float, [*r, t])) for r, t in zip(x, y)],
                               ", ".join(f"{c} double" for c in [*cols, "y"]))
    return df.withColumn("v", F.array(*cols)), cols


@pytest.mark.parametrize("d", [3, 12])
@pytest.mark.parametrize("fraction", [1.0, 0.3])
def test_regression_arrays_equal_columns(spark, d, fraction):
    df, cols = regression(spark, d)
    args = dict(num_iterations=15, step_size=0.3, intercept=True, mini_batch_fraction=fraction,
                sample_key=F.xxhash64("y"))
    a, b = LR.train_sgd(df, "y", cols, **args), LR.train_sgd(df, "y", "v", **args)
    assert np.allclose(a.weights, b.weights) and a.intercept == pytest.approx(b.intercept)
    p = [r[0] for r in a.predict(df).orderBy("y").select("prediction").collect()]
    q = [r[0] for r in b.predict(df, "v").orderBy("y").select("prediction").collect()]
    assert np.allclose(p, q)


@pytest.mark.parametrize("d", [3, 12])
@pytest.mark.parametrize("fraction", [1.0, 0.5])
def test_regression_on_nothing_is_an_error(spark, d, fraction):
    df, cols = regression(spark, d, 5)
    with pytest.raises(ValueError, match="at least one row"):
        LR.train_sgd(df.filter("y > 1e9"), "y", cols, mini_batch_fraction=fraction)


def test_mini_batch_fraction_needs_buckets(spark):
    df, cols = regression(spark, 3)
    with pytest.raises(ValueError, match="buckets"):
        LR.train_sgd(df, "y", cols, mini_batch_fraction=0.0001)
    assert len(LR.sampled_buckets(3, 2, 16384)) == 2
    LR.train_sgd(df, "y", cols, num_iterations=3, mini_batch_fraction=0.0002, buckets=16384)


def test_another_gradient_and_link(spark):
    """Least squares as a plug-in gives the built-in result; a link is applied to the margin."""
    df, cols = regression(spark, 3)
    a = LR.train_sgd(df, "y", cols, num_iterations=8, step_size=0.3, intercept=True)
    b = LR.train_sgd(df, "y", cols, num_iterations=8, step_size=0.3, intercept=True,
                     gradient=lambda margin, y: margin - y)
    assert np.allclose(a.weights, b.weights)
    r = a.predict(df, link=lambda m: 1 / (1 + F.exp(-m))).limit(1).collect()[0]
    m = sum(w * r[c] for w, c in zip(a.weights, cols)) + a.intercept
    assert r["prediction"] == pytest.approx(1 / (1 + math.exp(-m)))


def test_scoring_two_thousand_features(spark):
    d = 2000
    rng = np.random.default_rng(4)
    x = rng.random((20, d))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)],
                               "i long, v array<double>")
    w = rng.normal(0, 1, d)
    model = LR.LinearModel(list(map(float, w)), 0.5, [f"v[{j}]" for j in range(d)])
    got = [r[0] for r in model.predict(df, "v").orderBy("i").select("prediction").collect()]
    assert np.allclose(got, x @ w + 0.5)
    nb = NB.fit(df.withColumn("label", F.col("i") % 3), "label", "v")
    got = {r["i"]: r["prediction"] for r in NB.predict(nb, df, "v").collect()}
    y = np.arange(20) % 3
    theta = np.log(np.stack([x[y == k].sum(0) + 1 for k in range(3)]))
    theta -= np.log(np.stack([x[y == k].sum() + d for k in range(3)]))[:, None]
    prior = np.log([(y == k).sum() + 1 for k in range(3)]) - math.log(23)
    want = (x @ theta.T + prior).argmax(1)
    assert [got[i] for i in range(20)] == want.tolist()


@pytest.mark.parametrize("kind", ["multinomial", "bernoulli"])
def test_bayes_arrays_equal_columns_and_literals(spark, kind, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2 if kind == "bernoulli" else 5, (60, 4)).astype(float)
    df = spark.createDataFrame([(i, int(i % 3), *map(float, r)) for i, r in enumerate(x)],
                               "i long, y int, a double, b double, c double, d double")
    df = df.withColumn("v", F.array("a", "b", "c", "d"))
    for smoothing in (1.0, 0.0):
        m = NB.fit(df, "y", ["a", "b", "c", "d"], kind, smoothing)
        n = NB.fit(df, "y", "v", kind, smoothing)
        literal = NB.predict_proba(m, df, keep=["i"]).orderBy("i", "label").collect()
        monkeypatch.setattr(NB, "LITERAL_MAX", 0)
        product = NB.predict_proba(n, df, "v", keep=["i"]).orderBy("i", "label").collect()
        monkeypatch.undo()
        assert np.allclose([r["probability"] for r in literal],
                           [r["probability"] for r in product], equal_nan=True)


def test_bayes_many_classes_sparse_and_negative_scores(spark):
    """Fifty classes; multinomial scoring takes negative values."""
    rng = np.random.default_rng(6)
    cells = [(i, int(j), float(rng.integers(1, 4))) for i in range(200) for j in
             rng.choice(30, 4, replace=False)]
    cdf = spark.createDataFrame(cells, "row_id long, feature int, value double")
    rows = spark.createDataFrame([(i, i % 50) for i in range(200)], "row_id long, label int")
    model = NB.fit_sparse(cdf, rows, num_features=30)
    x = np.zeros((200, 30))
    for i, j, v in cells:
        x[i, j] = v
    y = np.arange(200) % 50
    s = np.stack([x[y == k].sum(0) for k in range(50)])
    theta = np.log(s + 1) - np.log(s.sum(1) + 30)[:, None]
    want = (x @ theta.T).argmax(1)
    got = {r["row_id"]: r["prediction"] for r in NB.predict_sparse(model, cdf, rows).collect()}
    scores = x @ theta.T
    assert all(scores[i, got[i]] >= scores[i, want[i]] - 1e-9 for i in range(200))
    negative = cdf.withColumn("value", -F.col("value"))
    low = {r["row_id"]: r["prediction"] for r in NB.predict_sparse(model, negative, rows).collect()}
    assert all(-scores[i, low[i]] >= (-scores[i]).max() - 1e-9 for i in range(200))
    with pytest.raises(Exception, match="outside"):
        NB.fit_sparse(cdf, rows, num_features=3)
    with pytest.raises(ValueError, match="distinct labels"):
        NB.fit_sparse(cdf, rows, max_classes=10)


def test_saving_refuses_to_replace(spark):
    path = scratch_path(spark, "model")
    one = LR.LinearModel([1.0], 0.0, ["x"])
    MD.save_linear(one, spark, path)
    with pytest.raises(Exception, match="(?i)exists"):
        MD.save_linear(one, spark, path)
    MD.save_linear(LR.LinearModel([2.0], 0.0, ["x"]), spark, path, overwrite=True)
    assert MD.load_linear(spark, path).weights == [2.0]
    df = spark.createDataFrame([(0, 1.0, 2.0), (1, 3.0, 0.0)], "y int, a double, b double")
    nb_path = scratch_path(spark, "nb")
    MD.save_nb(NB.fit(df, "y", ["a", "b"]), nb_path)
    MD.save_nb(MD.load_nb(spark, nb_path), nb_path, overwrite=True)  # onto its own path
    assert MD.load_nb(spark, nb_path).num_features == 2


def test_gaussian_of_a_full_row_keeps_other_columns(spark):
    d = 20
    rng = np.random.default_rng(7)
    a = rng.normal(0, 1, (d, d))
    g = G.Gaussian(rng.normal(0, 1, d), a @ a.T + np.eye(d))
    x = rng.normal(0, 1, (10, d))
    df = spark.createDataFrame([(f"t{i}", [float(v) for v in r]) for i, r in enumerate(x)],
                               "name string, v array<double>")
    got = {r["name"]: r["logpdf"] for r in G.score(df, "v", g).collect()}
    assert np.allclose([got[f"t{i}"] for i in range(10)], g.logpdf_np(x))


def test_stream_null_policy(spark):
    path = scratch_path(spark, "nulls")
    schema = "ts timestamp, value double, t boolean"
    data = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS ts, v AS value, v > 1 AS t "
                     "FROM VALUES (1.0D), (CAST(NULL AS DOUBLE)), (3.0D) AS x(v)")
    data.write.parquet(path)
    stream = spark.readStream.schema(schema).parquet(path)
    with pytest.raises(Exception, match="null value in value"):
        SS.run_to_table(stream, ["value"], "ts", "1 day", "1 day", scratch_path(spark, "o"),
                        scratch_path(spark, "c"))
    out = scratch_path(spark, "o")
    SS.run_to_table(stream, ["value"], "ts", "1 day", "1 day", out, scratch_path(spark, "c"),
                    nulls="drop")
    r = SS.finalize_windows(SS.latest_windows(spark, out), ["value"]).collect()[0]
    assert (r["count"], r["mean"]) == (2, 2.0)


def test_text_of_a_streaming_test(spark):
    row = spark.sql("SELECT 0.2D AS p_value, 12.5D AS degrees_of_freedom, 1.5D AS statistic, "
                    f"'{AB.METHOD_NAMES['student']}' AS method, 'h' AS null_hypothesis".replace(
                        "Student's", "Student\\'s"))
    text = H.explain(row).collect()[0]["summary"]
    assert text.startswith("Streaming test summary:\nmethod: Student's 2-sample t-test\n")
    assert "No presumption against null hypothesis: h." in text


def test_executors_import_the_package_from_anywhere(tmp_path):
    """Python started in another folder, the package known to the driver alone."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys; sys.path.insert(0, {root!r})
from statframe.session import local_session
spark = local_session(cpus=2)
from statframe.operators import gaussian, hypothesis
from pyspark.sql import functions as F
import numpy as np
df = spark.range(50).select((F.col('id') % 2).alias('y'), (F.col('id') / 50).alias('x'),
                            F.expr('transform(sequence(1, 20), i -> id * i / 1000.0D)').alias('v'))
assert hypothesis.chisq_features(df, 'y', ['x']).count() == 1
assert hypothesis.ks_test(df, 'x', lambda c: c).first()['p_value'] > 0.9
assert gaussian.score(df, 'v', gaussian.Gaussian(np.zeros(20), np.eye(20))).count() == 50
print('done')
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=300)
    assert got.stdout.strip().endswith("done"), got.stderr[-2000:]
