"""Blocked scoring, additive counts and impossible classes of naive Bayes."""

import math
import random

import pytest
from pyspark.sql import functions as F

from statframe.operators import bayes as NB


def data(spark, bernoulli=False, n=80, d=11, classes=5, seed=3):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(classes), *[float(rng.randrange(2 if bernoulli else 4)) for _ in range(d)])
            for i in range(n)]
    cols = [f"x{j}" for j in range(d)]
    return spark.createDataFrame(rows, "id long, y int, " + ", ".join(f"{c} double" for c in cols)), cols


@pytest.mark.parametrize("kind", NB.MODEL_TYPES)
def test_blocked_equals_dense(spark, kind):
    df, cols = data(spark, kind == NB.BERNOULLI)
    model = NB.fit(df, "y", cols, kind)
    want = {(r["id"], r["label"]): r["probability"] for r in
            NB.predict_proba(model, df, keep=["id"]).collect()}
    cells = NB.dense_cells(df, "id", cols)
    got = {(r["id"], r["label"]): r["probability"] for r in NB.predict_proba_blocked(
        model, cells, df, "id", features_per_block=3, classes_per_block=2, cells_per_block=50).collect()}
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(p, abs=1e-12) for k, p in want.items())
    labels = {r["id"]: r["prediction"] for r in NB.predict(model, df).collect()}
    assert {r["id"]: r["prediction"] for r in NB.predict_blocked(model, cells, df, "id").collect()} == labels


def test_blocked_sparse_strings(spark):
    """Unknown features, rows without cells, and a feature that nearly every row stores."""
    rng = random.Random(8)
    cells = [(i, t, float(rng.randrange(1, 4))) for i in range(60) for t in
             {"the", *(f"t{rng.randrange(40)}" for _ in range(5))}]
    cells = spark.createDataFrame(cells, "row_id int, feature string, value double")
    rows = spark.createDataFrame([(i, f"c{i % 3}") for i in range(60)], "row_id int, label string")
    model = NB.fit_sparse(cells, rows)
    more = cells.unionByName(spark.createDataFrame([(70, "unknown", 1.0), (71, "t1", 2.0)], cells.schema))
    ask = rows.select("row_id").unionByName(spark.createDataFrame([(70,), (71,), (72,)], "row_id int"))
    want = {(r["row_id"], r["label"]): r["probability"] for r in
            NB.predict_proba_sparse(model, more, ask).collect()}
    got = {(r["row_id"], r["label"]): r["probability"] for r in NB.predict_proba_blocked(
        model, more, ask, features_per_block=7, classes_per_block=2, cells_per_block=40).collect()}
    assert set(got) == set(want)
    assert all(got[k] == pytest.approx(p, abs=1e-12) for k, p in want.items())


@pytest.mark.parametrize("shuffled", [False, True])
def test_rows_and_their_products_are_shuffled_once(spark, monkeypatch, shuffled):
    """A model of one block's size is sent to the cells; the products of a row leave a task added up,
    meet its row and columns in one shuffle, and need no further one."""
    df, cols = data(spark, n=300)
    model = NB.fit(df, "y", cols)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        if shuffled:  # a model that is too large to be sent
            monkeypatch.setattr(NB, "FEATURES_PER_BLOCK", 1)
            monkeypatch.setattr(NB, "CLASSES_PER_BLOCK", 1)
        got = NB.predict_proba_blocked(model, NB.dense_cells(df, "id", cols), df, "id", keep=["y", "x0"],
                                       features_per_block=3, classes_per_block=2, cells_per_block=64)
        plan = got._jdf.queryExecution().executedPlan().toString()
        of_rows = plan.count("Exchange hashpartitioning(_row") + plan.count("Exchange hashpartitioning(id")
        assert of_rows == 2, plan  # the rows, the products
        want = {(r["id"], r["y"], r["x0"], r["label"]): r["probability"] for r in
                NB.predict_proba(model, df, keep=["id", "y", "x0"]).collect()}
        assert {(r["id"], r["y"], r["x0"], r["label"]): r["probability"] for r in got.collect()} == \
            pytest.approx(want, abs=1e-12)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_model_is_not_collected(spark, monkeypatch):
    """Blocked scoring takes one row per class from the model, never ``cond``."""
    df, cols = data(spark)
    model = NB.fit(df, "y", cols)
    monkeypatch.setattr(type(model.cond), "collect", lambda self: pytest.fail("collected"))
    model.pi_values()
    NB.scores_blocked(model, NB.dense_cells(df, "id", cols), df, "id").write.format("noop").mode(
        "overwrite").save()


@pytest.mark.parametrize("wide", [False, True])
def test_a_feature_that_is_always_on(spark, wide):
    """Smoothing 0, Bernoulli: a class whose feature is always on is ruled out by its absence; no NaN."""
    rows = [(1, 0, 1.0, 0.0), (2, 0, 1.0, 1.0), (3, 1, 0.0, 1.0), (4, 1, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id int, y int, a double, b double")
    cols = ["a", "b"]
    if wide:
        df = df.select("id", "y", F.array("a", "b").alias("v"))
        cols = "v"
    model = NB.fit(df, "y", cols, NB.BERNOULLI, smoothing=0.0, dim=2 if wide else None)
    got = {(r["id"], r["label"]): r["probability"] for r in
           NB.predict_proba(model, df, cols, keep=["id"]).collect()}
    # class 0: a always on, b half; class 1: a half, b always on
    assert got == pytest.approx({(1, 0): 1.0, (1, 1): 0.0, (2, 0): 0.5, (2, 1): 0.5, (3, 0): 0.0,
                                 (3, 1): 1.0, (4, 0): 0.5, (4, 1): 0.5})
    cells = spark.createDataFrame([(i, j, v) for i, _, a, b in rows for j, v in enumerate((a, b)) if v],
                                  "id int, feature int, value double")
    for f in (NB.predict_proba_sparse, NB.predict_proba_blocked):
        sparse = {(r["id"], r["label"]): r["probability"] for r in f(model, cells, df, row="id").collect()}
        assert sparse == pytest.approx(got)
    assert not any(math.isnan(p) for p in got.values())


def test_counts_add_up_and_come_out_again(spark):
    df, cols = data(spark, n=120)
    df = df.withColumn("day", (F.col("id") % 4).cast("int"))
    days = NB.count_table(df, "y", cols, by=["day"])
    kept = NB.remove_counts(NB.add_counts(days), days.filter("day = 2").drop("day"))
    want = NB.fit(df.filter("day <> 2"), "y", cols)
    got = NB.fit_counts(kept, feature_names=cols)

    def table(m):
        return sorted((r["label"], r["feature"], round(r["theta"], 12), round(r["pi"], 12))
                      for r in m.cond.join(m.prior, "label").collect())

    assert table(got) == table(want) and got.num_features == want.num_features == 11
    again = NB.fit_counts(NB.add_counts(kept, days.filter("day = 2").drop("day")))
    assert table(again) == table(NB.fit(df, "y", cols))
    with pytest.raises(Exception, match="more rows are taken out"):
        NB.remove_counts(kept, NB.add_counts(days)).collect()
    none = NB.remove_counts(NB.add_counts(days), days.drop("day"))
    assert none.collect() == []
    with pytest.raises(ValueError, match="at least one labelled row"):
        NB.fit_counts(none)


def test_bernoulli_counts(spark):
    df, cols = data(spark, bernoulli=True)
    got = NB.fit_counts(NB.count_table(df, "y", cols, NB.BERNOULLI), NB.BERNOULLI)
    want = NB.fit(df, "y", cols, NB.BERNOULLI)
    assert sorted((r["label"], r["feature"], round(r["theta"], 12)) for r in got.cond.collect()) == \
        sorted((r["label"], r["feature"], round(r["theta"], 12)) for r in want.cond.collect())
