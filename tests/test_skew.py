"""Skewed inputs: one value / key holding a third or more of all rows.
Results are compared with brute force (pandas) on the same rows."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from statframe.operators import bayes as NB
from statframe.operators import correlation as C
from statframe.operators import hypothesis as H
from statframe.operators import rank as R


def skewed_lineitem(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    hot = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(3)) == 0
    return li.select("l_orderkey", "l_linenumber",
                     F.when(hot, F.lit(1234.5)).otherwise(F.col("l_extendedprice")).alias("price"),
                     F.when(hot, F.lit(0.0)).otherwise(F.col("l_discount")).alias("disc"),
                     F.when(hot, F.lit("HOT")).otherwise(F.col("l_returnflag")).alias("flag"),
                     "l_linestatus")


def test_ranks_with_a_hot_value(spark):
    df = skewed_lineitem(spark)
    pdf = df.toPandas()
    want = pdf["price"].rank(method="average") - 1  # 0-based average ranks
    got = R.avg_rank(df, ["price"]).select("l_orderkey", "l_linenumber", "price",
                                           "price_rank").toPandas()
    merged = pdf.assign(want=want).merge(got, on=["l_orderkey", "l_linenumber", "price"])
    assert len(merged) >= len(pdf)
    assert np.allclose(merged["want"], merged["price_rank"])
    assert (pdf["price"] == 1234.5).mean() > 0.3


def test_spearman_with_hot_values(spark):
    df = skewed_lineitem(spark)
    pdf = df.toPandas()
    want = pdf[["price", "disc"]].rank().corr().iloc[0, 1]
    got = C.corr_pair(df, "price", "disc", "spearman").collect()[0]["corr"]
    assert math.isclose(got, want, rel_tol=1e-9)


def test_chi_square_features_with_a_hot_category(spark):
    df = skewed_lineitem(spark)
    pdf = df.toPandas()
    table = pd.crosstab(pdf["flag"], pdf["l_linestatus"]).to_numpy().astype(float)
    e = table.sum(1, keepdims=True) * table.sum(0, keepdims=True) / table.sum()
    want = ((table - e) ** 2 / e).sum()
    got = H.chisq_features(df, "l_linestatus", ["flag"]).collect()[0]
    assert math.isclose(got["statistic"], want, rel_tol=1e-9)


def test_sparse_naive_bayes_with_a_hot_document(spark):
    """One document holds most of the cells; scoring equals the dense form."""
    rows = [(0, 0.0), (1, 1.0), (2, 0.0)]
    cells = [(0, j % 50, 1.0 + (j % 3)) for j in range(3000)] + [(1, 1, 2.0), (2, 7, 1.0)]
    cdf = spark.createDataFrame(cells, "rid int, feature int, value double") \
        .groupBy("rid", "feature").agg(F.sum("value").alias("value"))
    ldf = spark.createDataFrame(rows, "rid int, label double")
    m = NB.fit_sparse(cdf, ldf, row="rid", num_features=50)
    dense_rows = cdf.groupBy("rid").pivot("feature", list(range(50))).agg(F.first("value")) \
        .na.fill(0.0).join(ldf, "rid")
    names = [str(j) for j in range(50)]
    md = NB.fit(dense_rows, "label", names)
    ps = {(r["rid"], r["label"]): r["probability"]
          for r in NB.predict_proba_sparse(m, cdf, ldf, row="rid").collect()}
    pdn = {(r["rid"], r["label"]): r["probability"]
           for r in NB.predict_proba(md, dense_rows, names, keep=["rid"]).collect()}
    assert ps.keys() == pdn.keys()
    for k in ps:
        assert math.isclose(ps[k], pdn[k], rel_tol=1e-9, abs_tol=1e-12)
