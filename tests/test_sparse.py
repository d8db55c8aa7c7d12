"""Sparse covariance, correlation, feature tests and regression against their dense forms."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from statframe.operators import hypothesis as H
from statframe.operators import linear as LR
from statframe.operators import sparse as SP
from statframe.operators import sparse_linear as SL


def matrix(n=60, d=9, seed=1, fill=0.3):
    rng = np.random.default_rng(seed)
    x = rng.integers(1, 9, (n, d)) * (rng.random((n, d)) < fill) * rng.choice([1, -1, 0.5], (n, d))
    x[3] = 0  # a row without cells
    x[5] = rng.integers(1, 5, d)  # and a full one
    return x


def cells_of(spark, x, name=lambda j: j, kind="int"):
    rows = [(i, name(j), float(v)) for i, r in enumerate(x) for j, v in enumerate(r) if v]
    return spark.createDataFrame(rows, f"row_id int, feature {kind}, value double").repartition(5)


def as_dict(df, value):
    return {(r["feature_i"], r["feature_j"]): r[value] for r in df.collect()}


@pytest.mark.parametrize("split", [512, 3, 1])
def test_cov_and_corr(spark, split):
    """Rows whole, cut into blocks, and cut into single cells."""
    x = matrix()
    cross = SP.cross_products(cells_of(spark, x), num_rows=len(x), split=split)
    want, corr = np.cov(x.T), np.corrcoef(x.T)
    got = as_dict(cross.cov(), "cov")
    met = {(i, j) for r in x for i in range(9) for j in range(i, 9) if r[i] and r[j]}
    assert set(got) == met
    for (i, j), v in got.items():
        assert v == pytest.approx(want[i, j], rel=1e-12, abs=1e-12)
    for (i, j), v in as_dict(cross.corr(), "corr").items():
        assert v == pytest.approx(corr[i, j], abs=1e-12)


def test_pairs_that_never_meet(spark):
    x = np.zeros((10, 3))
    x[0, 0], x[1, 1], x[2, 2], x[3, 2] = 4.0, 2.0, 1.0, 1.0
    cross = SP.cross_products(cells_of(spark, x), num_rows=10)
    assert (0, 1) not in as_dict(cross.cov(), "cov")
    pairs = spark.createDataFrame([(1, 0), (0, 2), (2, 2), (0, 77)], "feature_i int, feature_j int")
    got = as_dict(cross.cov_at(pairs), "cov")
    want = np.cov(x.T)
    assert got == pytest.approx({(0, 1): want[0, 1], (0, 2): want[0, 2], (2, 2): want[2, 2]})


def test_string_features_and_support(spark):
    x = matrix(seed=4)
    named = SP.cov_sparse(cells_of(spark, x, lambda j: f"t{j}", "string"), num_rows=len(x))
    want = np.cov(x.T)
    for (i, j), v in as_dict(named, "cov").items():
        assert v == pytest.approx(want[int(i[1:]), int(j[1:])], abs=1e-12)
    enough = {j for j in range(9) if (x[:, j] != 0).sum() >= 20}
    some = as_dict(SP.cov_sparse(cells_of(spark, x), num_rows=len(x), min_rows=20), "cov")
    assert {i for p in some for i in p} == enough and 0 < len(enough) < 9


def test_a_row_with_most_cells_is_cut(spark):
    """One row holds two thirds of all cells; its pairs are many records, each bounded."""
    d = 300
    x = np.zeros((151, d))
    x[0] = np.arange(1, d + 1)
    x[np.arange(1, 151), np.arange(150)] = 1.0
    cross = SP.cross_products(cells_of(spark, x), split=32)
    assert cross.n == 151 and cross.cross.count() == d * (d + 1) // 2
    got = cross.cov().agg(F.sum("cov")).first()[0]
    assert got == pytest.approx(np.triu(np.cov(x.T)).sum(), rel=1e-9)


def batch_of(left, right):
    kind = pa.list_(pa.struct([("_f", pa.string()), ("_x", pa.float64())]))
    return pa.RecordBatch.from_arrays([pa.array([[{"_f": f, "_x": x} for f, x in r.items()] if r is not None
                                                 else None for r in side], kind) for side in (left, right)],
                                      names=["_c", "_d"])


@pytest.mark.parametrize("sizes", [{}, {"DENSE_WIDTH": 0}, {"CHUNK_CELLS": 7}, {"DENSE_WIDTH": 0, "CHUNK_PAIRS": 5}])
def test_rows_are_multiplied_together(monkeypatch, sizes):
    """The sums of a chunk of rows leave a task, not their products: by matrix, listed, in small chunks."""
    for name, n in sizes.items():
        monkeypatch.setattr(SP, name, n)
    rng = random.Random(5)
    left = [{f"t{j}": float(rng.randrange(1, 9)) for j in range(9) if rng.random() < 0.4} for _ in range(200)]
    right = [None if i % 3 else {f"u{j}": 2.0 for j in range(4) if rng.random() < 0.5} for i in range(200)]
    left[7], right[7] = {"t1": float("nan"), "t2": 2.0}, None
    want, products = {}, 0
    for c, d in zip(left, right):
        for a, x in c.items():
            for b, y in (c if d is None else d).items():
                if d is not None or a <= b:
                    want[a, b] = want.get((a, b), 0.0) + x * y
                    products += 1
    got, rows = {}, 0
    for b in SP._multiply([batch_of(left, right)]):
        for r in b.to_pylist():
            pair = tuple(sorted((r["a"], r["b"])))
            got[pair], rows = got.get(pair, 0.0) + r["value"], rows + 1
    assert got == pytest.approx(want, nan_ok=True) and len(got) == len(want)
    assert rows == len(want) or sizes and rows < products


def test_constant_feature_and_errors(spark):
    one = spark.createDataFrame([(i, 0, 2.0) for i in range(4)] + [(0, 1, 1.0)],
                                "row_id int, feature int, value double")
    got = as_dict(SP.corr_sparse(one), "corr")
    assert got[0, 0] == 1.0 and np.isnan(got[0, 1])
    with pytest.raises(ValueError, match="more than one row"):
        SP.cov_sparse(one, num_rows=1)
    twice = spark.createDataFrame([(0, 0, 2.0), (0, 0, 1.0)], one.schema)
    with pytest.raises(Exception, match="stores a feature twice"):
        SP.cov_sparse(twice)
    null = spark.createDataFrame([(0, 0, None), (1, 0, 1.0)], one.schema)
    with pytest.raises(Exception, match="null value"):
        SP.cov_sparse(null)
    assert SP.cov_sparse(spark.createDataFrame([], one.schema), num_rows=5).collect() == []


def test_top_pairs(spark):
    x = matrix(seed=8)
    corr = SP.corr_sparse(cells_of(spark, x), num_rows=len(x))
    got = [(r["feature_i"], r["feature_j"]) for r in SP.top_pairs(corr, k=4).collect()]
    all_ = sorted((-abs(v), i, j) for (i, j), v in as_dict(corr, "corr").items() if i != j)
    assert got == [(i, j) for _, i, j in all_[:4]]


# ------------------------------------------------------------- feature tests

def labelled(n=120, d=6, seed=2):
    rng = random.Random(seed)
    labels = [rng.choice("abc") for _ in range(n)]
    x = [[rng.choice([0, 0, 0, 1, 2]) if j else (2 if c == "a" else 0) for j in range(d)] for c in labels]
    for r in x:
        r[d - 1] = 3  # the same everywhere
    return x, labels


def test_feature_tests_equal_the_dense_ones(spark):
    x, labels = labelled()
    dense = spark.createDataFrame([(c, *map(float, r)) for c, r in zip(labels, x)],
                                  "label string, " + ", ".join(f"x{j} double" for j in range(6)))
    rows = spark.createDataFrame(list(enumerate(labels)), "row_id int, label string")
    extra = spark.createDataFrame([(9999, 0, 5.0)], "row_id int, feature int, value double")
    cells = cells_of(spark, x).unionByName(extra)  # a row that is not labelled
    got = {r["feature"]: r for r in SP.chisq_features_sparse(cells, rows).collect()}
    want = {r["feature_index"]: r for r in H.chisq_features(dense, "label", [f"x{j}" for j in range(6)]).collect()}
    assert set(got) == set(want) == set(range(6))
    for j, w in want.items():
        g = got[j]
        assert g["degrees_of_freedom"] == w["degrees_of_freedom"]
        assert g["statistic"] == pytest.approx(w["statistic"], abs=1e-9)
        assert g["p_value"] == pytest.approx(w["p_value"], abs=1e-12)
    assert got[0]["p_value"] < 1e-10 and got[5]["p_value"] == 1.0


def test_feature_test_errors(spark):
    rows = spark.createDataFrame([(0, "a"), (1, "b")], "row_id int, label string")
    kind = "row_id int, feature int, value double"
    with pytest.raises(Exception, match="listed twice|feature twice"):
        SP.chisq_features_sparse(spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0), (1, 0, 1.0)], kind),
                                 rows).collect()
    with pytest.raises(ValueError, match="labelled row"):
        SP.chisq_features_sparse(spark.createDataFrame([(0, 0, 1.0)], kind), rows.limit(0))
    many = spark.createDataFrame([(i, 0, float(i)) for i in range(1, 9)], kind)
    every = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(9)], rows.schema)
    with pytest.raises(ValueError, match="9 distinct values"):
        SP.chisq_features_sparse(many, every, max_categories=8)
    with pytest.raises(ValueError, match="more than 1 distinct"):
        SP.chisq_features_sparse(many, every, max_categories=1)


# ------------------------------------------------------------------ regression

@pytest.mark.parametrize("intercept,start", [(False, None), (True, [0.5, -1, 0, 0, 2])])
def test_sgd_equals_the_dense_replay(spark, intercept, start):
    x = matrix(n=80, d=5, seed=6) / 4
    y = x @ [1.0, -2.0, 0.5, 0.0, 3.0] + 0.7
    dense = spark.createDataFrame([(float(t), *map(float, r)) for t, r in zip(y, x)],
                                  "y double, " + ", ".join(f"x{j} double" for j in range(5)))
    want = LR.train_sgd(dense, "y", [f"x{j}" for j in range(5)], num_iterations=6, step_size=0.4,
                        intercept=intercept, initial_weights=start)
    rows = spark.createDataFrame([(i, float(t)) for i, t in enumerate(y)], "row_id int, label double")
    first = None if start is None else spark.createDataFrame(
        [(j, float(w)) for j, w in enumerate(start) if w], "feature int, weight double")
    cells = cells_of(spark, x)
    got = SL.train_sgd_sparse(cells, rows, num_iterations=6, step_size=0.4, intercept=intercept,
                              initial_weights=first, split=7)
    weights = {r["feature"]: r["weight"] for r in got.weights.collect()}
    assert [weights.get(j, 0.0) for j in range(5)] == pytest.approx(want.weights, abs=1e-12)
    assert got.intercept == pytest.approx(want.intercept, abs=1e-12)
    assert got.loss_history == pytest.approx(want.loss_history) and got.iterations == want.iterations
    predicted = {r["row_id"]: r["prediction"] for r in got.predict(cells, rows).collect()}
    assert [predicted[i] for i in range(80)] == pytest.approx(
        list(x @ want.weights + want.intercept), abs=1e-11)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("statframe_")]


def test_sgd_stops_and_empty(spark):
    rows = spark.createDataFrame([(i, 2.0) for i in range(4)], "row_id int, label double")
    cells = spark.createDataFrame([(i, 7, 1.0) for i in range(4)], "row_id int, feature int, value double")
    got = SL.train_sgd_sparse(cells, rows, num_iterations=50)
    assert got.iterations == 2 and got.weights.collect() == [(7, 2.0)]
    with pytest.raises(ValueError, match="at least one row"):
        SL.train_sgd_sparse(cells, rows.limit(0))


def test_sgd_at_a_million_features(spark):
    """Width 10^6: weights stay a table, and what reaches the driver does not follow the width."""
    n, each = 4000, 10
    cells = spark.range(n * each).select(
        (F.col("id") / each).cast("int").alias("row_id"),
        (F.pmod(F.xxhash64("id"), F.lit(1_000_000))).cast("int").alias("feature"),
        F.lit(1.0).alias("value")).dropDuplicates(["row_id", "feature"])
    rows = spark.range(n).select(F.col("id").cast("int").alias("row_id"),
                                 (F.col("id") % 7).cast("double").alias("label"))
    limit = spark.conf.get("spark.driver.maxResultSize", "1g")
    got = SL.train_sgd_sparse(cells, rows, num_iterations=2, step_size=0.1)
    assert limit and got.iterations == 2
    assert got.weights.count() > 35_000
    assert got.loss_history[1] < got.loss_history[0]


def test_cells_stay_where_they_were_laid_out(spark):
    """The joins of an iteration shuffle weights and residuals, not the cells."""
    tables = SL._Tables(spark)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        cells = cells_of(spark, matrix()).withColumnRenamed("row_id", "_r")
        laid = tables.lay_out(cells, "feature")
        w = spark.range(9).select(F.col("id").cast("int").alias("feature"), F.rand(1).alias("weight"))
        plan = laid.join(w, "feature")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(feature") == 1 and "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
        tables.drop()
