"""Small checks for inventory items not exercised elsewhere."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from statframe.operators import bayes as NB
from statframe.operators import hypothesis as H
from statframe.session import scratch_path
from statframe.sources import models as MD


def test_t13_unknown_chi_square_method(spark):
    obs = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "category string, observed double")
    with pytest.raises(ValueError, match="unrecognized method"):
        H.chisq_gof(obs, method="Pearson")


def test_io4_unknown_version(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 0.0)], "label double, a double")
    m = NB.fit(df, "label", ["a"])
    path = scratch_path(spark, "nb-version")
    MD.save_nb(m, path)
    meta = MD.read_metadata(spark, path)
    meta["version"] = "3.0"
    spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}/metadata")
    with pytest.raises(ValueError, match="unknown model format version"):
        MD.load_nb(spark, path)
    with pytest.raises(ValueError, match="multinomial models only"):
        MD.save_nb(NB.fit(df, "label", ["a"], NB.BERNOULLI), scratch_path(spark, "x"), "1.0")


def test_ks_distinct_value_form_equals_row_form(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    x = np.sort(ev.select("value").toPandas()["value"].to_numpy())
    n = len(x)
    cdf = 1 - np.exp(-x / 50.0)
    i = np.arange(n)
    d_row = max(np.abs(i / n - cdf).max(), np.abs((i + 1) / n - cdf).max())
    got = H.ks_test(ev, "value", lambda c: 1 - F.exp(-c / 50.0)).collect()[0]["statistic"]
    assert math.isclose(got, d_row, rel_tol=1e-12)


def test_ks_small_sample_matches_builtin_matrix_method(spark):
    from pyspark.mllib.stat import Statistics

    x = [0.1 * i - 1.3 + 0.05 * (i % 3) for i in range(37)]
    ref = Statistics.kolmogorovSmirnovTest(spark.sparkContext.parallelize(x, 3), "norm", 0.0, 1.0)
    r = H.ks_test(spark.createDataFrame([(v,) for v in x], "x double"), "x").collect()[0]
    assert math.isclose(r["statistic"], ref.statistic, rel_tol=1e-12)
    assert math.isclose(r["p_value"], ref.pValue, rel_tol=1e-9)


def test_ks_empty_input_is_an_error(spark):
    df = spark.createDataFrame([], "x double")
    with pytest.raises(Exception, match="at least one value"):
        H.ks_test(df, "x").collect()


def test_corr_paired_by_key_equals_same_row(spark):
    from statframe.operators import correlation as C

    li = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    x = li.select("o_orderkey", "o_totalprice")
    y = li.select("o_orderkey", (F.col("o_custkey") * 1.0).alias("c"))
    a = C.corr_paired(x, y, "o_orderkey", "o_totalprice", "c").collect()[0]["corr"]
    b = C.corr_pair(li.withColumn("c", F.col("o_custkey") * 1.0), "o_totalprice", "c") \
        .collect()[0]["corr"]
    assert math.isclose(a, b, rel_tol=1e-12)


def test_ks_numpy_cdf_equals_column_cdf(spark):
    from statframe.functions.special import numpy_cdf

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    a = H.ks_test(ev, "value", numpy_cdf(lambda v: 1 - np.exp(-v / 50.0))).collect()[0]
    b = H.ks_test(ev, "value", lambda c: 1 - F.exp(-c / 50.0)).collect()[0]
    assert math.isclose(a["statistic"], b["statistic"], rel_tol=1e-12)
    assert math.isclose(a["p_value"], b["p_value"], rel_tol=1e-9)


def test_t5_category_cap(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    with pytest.raises(ValueError, match="feature 'l_tax' has more than 5 distinct values"):
        H.chisq_features(li, "l_linestatus", ["l_returnflag", "l_tax"], max_categories=5)
    with pytest.raises(ValueError, match="label 'l_quantity'"):
        H.chisq_features(li, "l_quantity", ["l_returnflag"], max_categories=5)


def test_term_counts_and_tf_idf_match_brute_force(spark):
    import re
    from collections import Counter

    from statframe.functions import text as TX

    docs = [(1, "The cat sat; the CAT ran."), (2, "A dog, a cat!"), (3, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    counts = TX.term_counts(df, "doc_id", "text")
    got = {(r["doc_id"], r["term"]): r["tf"] for r in counts.collect()}
    want = {}
    for d, t in docs:
        for term, c in Counter(re.findall("[a-z0-9]+", t.lower())).items():
            want[(d, term)] = float(c)
    assert got == want
    n_docs = len({d for d, _ in want})
    dfreq = Counter(term for _, term in want)
    tfidf = {(r["doc_id"], r["term"]): r["tf"] for r in TX.tf_idf(counts, "doc_id").collect()}
    for (d, term), tf in want.items():
        assert math.isclose(tfidf[(d, term)], tf * math.log((n_docs + 1) / (dfreq[term] + 1)))
    assert {r["tf"] for r in TX.term_presence(counts).collect()} == {1.0}


def test_input_guards(spark):
    from statframe.functions.columns import apply_null_policy, features

    df = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises(ValueError, match="nulls must be one of"):
        apply_null_policy(df, ["x"], "ignore")
    empty = spark.createDataFrame([], "v array<double>")
    with pytest.raises(ValueError, match="empty dataset"):
        features(empty, "v")
    with pytest.raises(ValueError, match="at least one feature"):
        features(df, [])
