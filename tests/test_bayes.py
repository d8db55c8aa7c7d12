import math

import pytest
from pyspark.sql import functions as F

from statframe.operators import bayes as NB
from statframe.sources import models as MD
from statframe.session import scratch_path

F22 = [(0.0, 1.0, 0.0, 1.0), (0.0, 1.0, 1.0, 0.0), (1.0, 0.0, 1.0, 1.0)]
COLS = ["a", "b", "c"]


def data(spark):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(F22)],
                                 "rid int, label double, a double, b double, c double")


def theta(model):
    t = {(r["label"], r["feature"]): r["theta"] for r in model.cond.collect()}
    return [[t[(lab, j)] for j in range(model.num_features)] for lab in model.labels]


def allclose(a, b, tol=1e-8):
    return all(math.isclose(x, y, rel_tol=tol, abs_tol=tol) for x, y in zip(a, b))


def test_f22_multinomial(spark):
    m = NB.fit(data(spark), "label", COLS)
    assert allclose(m.pi_values(), [-0.51082562, -0.91629073])
    th = theta(m)
    assert allclose(th[0], [-0.84729786, -1.25276297, -1.25276297])
    assert allclose(th[1], [-1.60943791, -0.91629073, -0.91629073])
    post = {(r["rid"], r["label"]): r["probability"]
            for r in NB.predict_proba(m, data(spark), keep=["rid"]).collect()}
    assert allclose([post[(0, 0.0)], post[(1, 0.0)], post[(2, 0.0)]],
                    [0.6965944272, 0.6965944272, 0.4335260116])
    preds = [r["prediction"] for r in NB.predict(m, data(spark)).orderBy("rid").collect()]
    assert preds == [0.0, 0.0, 1.0]


def test_f23_bernoulli(spark):
    m = NB.fit(data(spark), "label", COLS, NB.BERNOULLI)
    th = theta(m)
    assert allclose(th[0], [-0.28768207, -0.69314718, -0.69314718])
    assert allclose(th[1], [-1.09861229, -0.40546511, -0.40546511])
    post = {(r["rid"], r["label"]): r["probability"]
            for r in NB.predict_proba(m, data(spark), keep=["rid"]).collect()}
    assert allclose([post[(0, 0.0)], post[(1, 0.0)], post[(2, 0.0)]],
                    [0.7915309446, 0.7915309446, 0.2403560831])


def test_f24_zero_smoothing_unseen_cell(spark):
    df = spark.createDataFrame([(0.0, 1.0, 0.0)], "label double, a double, b double")
    m = NB.fit(df, "label", ["a", "b"], smoothing=0.0)
    assert theta(m)[0] == [0.0, float("-inf")]
    # a zero count on the -inf feature adds 0 (documented deviation)
    assert NB.predict(m, df).collect()[0]["prediction"] == 0.0


def test_f25_bad_input(spark):
    neg = spark.createDataFrame([(0.0, -1.0)], "label double, a double")
    with pytest.raises(Exception, match="nonnegative"):
        NB.fit(neg, "label", ["a"])
    nan = spark.createDataFrame([(0.0, float("nan"))], "label double, a double")
    with pytest.raises(Exception, match="nonnegative"):
        NB.fit(nan, "label", ["a"])
    two = spark.createDataFrame([(0.0, 1.0), (0.0, 2.0)], "label double, a double")
    with pytest.raises(Exception, match="0 or 1"):
        NB.fit(two, "label", ["a"], NB.BERNOULLI)
    with pytest.raises(ValueError):
        NB.fit(two, "label", ["a"], "Multinomial")
    with pytest.raises(ValueError):
        NB.fit(two, "label", ["a"], smoothing=-1.0)


def _cells(spark):
    d = data(spark)
    return d.select("rid", F.inline(F.array(*[
        F.struct(F.lit(j).alias("feature"), F.col(c).alias("value")) for j, c in enumerate(COLS)
    ]))).filter("value != 0")


@pytest.mark.parametrize("kind", [NB.MULTINOMIAL, NB.BERNOULLI])
def test_sparse_equals_dense(spark, kind):
    dense = NB.fit(data(spark), "label", COLS, kind)
    sparse = NB.fit_sparse(_cells(spark), data(spark), row="rid", model_type=kind,
                           num_features=3)
    assert allclose(sum(theta(dense), []), sum(theta(sparse), []))
    pd_ = {(r["rid"], r["label"]): r["probability"]
           for r in NB.predict_proba(dense, data(spark), keep=["rid"]).collect()}
    ps = {(r["rid"], r["label"]): r["probability"]
          for r in NB.predict_proba_sparse(sparse, _cells(spark), data(spark), row="rid").collect()}
    assert pd_.keys() == ps.keys()
    assert allclose([pd_[k] for k in sorted(pd_)], [ps[k] for k in sorted(ps)])


def test_empty_row_scores_prior(spark):
    m = NB.fit_sparse(_cells(spark), data(spark), row="rid", num_features=3)
    rows = spark.createDataFrame([(99,)], "rid int")
    out = NB.predict_proba_sparse(m, _cells(spark).limit(0), rows, row="rid").collect()
    probs = {r["label"]: r["probability"] for r in out}
    assert allclose([probs[0.0], probs[1.0]], [3 / 5, 2 / 5])  # (n_c + 1) / (N + 2)


def test_matches_builtin(spark):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import VectorAssembler

    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(
        (F.col("l_returnflag") == "R").cast("double").alias("label"), "l_quantity",
        F.round(F.col("l_tax") * 100).alias("tax"))
    vec = VectorAssembler(inputCols=["l_quantity", "tax"], outputCol="features").transform(li)
    ref = NaiveBayes(smoothing=1.0, modelType="multinomial").fit(vec)
    ours = NB.fit(li, "label", ["l_quantity", "tax"])
    assert allclose(ours.pi_values(), ref.pi.toArray().tolist(), 1e-12)
    assert allclose(sum(theta(ours), []), ref.theta.toArray().ravel().tolist(), 1e-12)


@pytest.mark.parametrize("version", ["1.0", "2.0"])
def test_save_load_roundtrip(spark, version):
    m = NB.fit(data(spark), "label", COLS)
    path = scratch_path(spark, "nb-test")
    MD.save_nb(m, path, version=version)
    back = MD.load_nb(spark, path)
    assert back.model_type == NB.MULTINOMIAL and back.labels == m.labels
    assert allclose(sum(theta(back), []), sum(theta(m), []), 1e-15)


def test_load_shape_check(spark):
    m = NB.fit(data(spark), "label", COLS)
    path = scratch_path(spark, "nb-bad")
    MD.save_nb(m, path)
    m.cond.filter("feature != 2").write.mode("overwrite").parquet(f"{path}/data/cond")
    with pytest.raises(ValueError, match="numClasses x numFeatures"):
        MD.load_nb(spark, path)
