"""The ordinal model: held-out accuracy, ordering, and awkward inputs."""

import random

import numpy as np
import pytest
from odd import empty, frame, rows
from pyspark.sql import functions as F

from statframe.llm import toxicity

MEAN = "vilestan vilesto grumpole grumpor scornik".split()


def corpus(n=900, seed=5):
    """Plain documents, a tenth with rude words; odd doc_ids are labelled."""
    rng = random.Random(seed)
    calm = [a + b for a in "ta ri so ne lu mo".split() for b in "den ker lis mor tan vex".split()]
    docs, truth = [], {}
    for i in range(n):
        words = [rng.choice(calm) for _ in range(rng.choice([20, 60, 400]))]
        truth[i] = 0
        if i % 10 < 2:
            truth[i] = rng.choice([1, 2, 6])
            for _ in range(truth[i]):
                words.insert(rng.randrange(len(words)), rng.choice(MEAN).title() + ",")
        docs.append((i, " ".join(words), "en", "s", 0, "", "", 0, "", 0, ""))
    return docs, truth


@pytest.fixture(scope="module")
def fitted(spark):
    docs, truth = corpus()
    labels = [(i, int(t > 0)) for i, t in truth.items() if i % 2] + [(None, 1), (3, None), (9999, 1)]
    return docs, truth, toxicity.fit(frame(spark, docs), spark.createDataFrame(
        labels, "doc_id long, toxic int"))


def test_held_out_accuracy(spark, fitted):
    docs, truth, model = fitted
    got = {r.doc_id: r for r in toxicity.score(frame(spark, docs), model).collect()}
    held = [i for i in truth if not i % 2]
    assert all((got[i].p_toxic >= 0.5) == (truth[i] > 0) for i in held)
    # more rude words, more severe
    mean = {n: np.mean([got[i].severity for i in held if truth[i] == n]) for n in (0, 1, 2, 6)}
    assert mean[0] < 0.3 < mean[1] <= mean[2] < mean[6]
    assert {got[i].grade for i in held} == {0, 1, 2}


def test_probabilities_are_ordered(spark, fitted):
    _, _, model = fitted
    assert model.thresholds[0] < model.thresholds[1]
    p = model.at_least(np.linspace(-20, 20, 50))
    assert (p[:, 0] >= p[:, 1]).all() and (np.diff(p, axis=0) >= 0).all()


def test_odd_documents(spark, fitted):
    got = toxicity.score(frame(spark), fitted[2]).collect()
    assert len(got) == len(rows())
    assert all(0 <= r.severity <= 2 for r in got)
    assert toxicity.score(empty(spark), fitted[2]).count() == 0


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0)], [(100, 1)], [(100, 1), (100, 0)]])
def test_nothing_to_learn(spark, labels):
    model = toxicity.fit(frame(spark), spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = toxicity.score(frame(spark), model)
    assert got.agg(F.max("severity")).first()[0] == 0


def test_gradient_finds_the_optimum():
    """The fitted point beats small moves in every direction."""
    rng = np.random.default_rng(0)
    x = rng.integers(0, 3, (300, 2)).astype(float)
    grade = np.clip((x @ [1.0, -0.5] + rng.normal(0, 0.7, 300)).round(), 0, 2).astype(int)
    rows_ = [{j: v for j, v in enumerate(r) if v} for r in x]
    w, t = toxicity.fit_cumulative(rows_, grade, np.ones(300), 2, penalty=0.3, steps=1500)

    def value(w, t):
        p = 1 / (1 + np.exp(np.asarray(t)[None] - (x @ w)[:, None]))
        each = np.stack([1 - p[:, 0], p[:, 0] - p[:, 1], p[:, 1]], 1)
        return np.log(each[np.arange(300), grade]).sum() - 0.15 * (w @ w)

    best = value(w, t)
    for k in range(4):
        for e in (-0.05, 0.05):
            w2, t2 = w.copy(), t.copy()
            (w2 if k < 2 else t2)[k % 2] += e
            assert value(w2, t2) < best


def test_sample_bound_is_kept(spark):
    docs, truth = corpus(200)
    labels = spark.createDataFrame([(i, int(t > 0)) for i, t in truth.items()],
                                   "label_id long, toxic int")
    sample, n_clean, n_toxic = toxicity._sample(
        frame(spark, docs).select("doc_id", "text"), labels, 7, 11)
    assert sample.count() == 18 and n_clean + n_toxic == 200


def test_a_labelled_id_that_many_rows_carry(spark):
    """The sample is bounded in rows: a third of the table under one labelled doc_id is one of them."""
    docs, truth = corpus(200)
    hot = next(i for i, t in truth.items() if t > 0)
    many = spark.range(3000).select(F.lit(hot).cast("long").alias("doc_id"),
                                    F.concat(F.lit("row "), F.col("id").cast("string")).alias("text"))
    labels = spark.createDataFrame([(i, int(t > 0)) for i, t in truth.items()],
                                   "label_id long, toxic int")
    rows_ = frame(spark, docs).select("doc_id", "text").unionByName(many)
    sample, n_clean, n_toxic = toxicity._sample(rows_, labels, 500, 500)
    assert sample.count() == 200 == n_clean + n_toxic
    again, _, _ = toxicity._sample(rows_.repartition(7), labels, 500, 500)
    assert sorted(sample.collect()) == sorted(again.collect())
