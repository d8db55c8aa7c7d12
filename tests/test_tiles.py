"""Tiled co-moments against numpy, and wide matrices that come out the same every time."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from oracle_compare import duck
from statframe.operators import correlation as C

SF = "/root/testdata/sf0.01"


def array_frame(spark, x, parts=5):
    return spark.createDataFrame([(r.tolist(),) for r in x], "v array<double>").repartition(parts)


def dense(df, d):
    out = np.full((d, d), np.nan)
    for r in df.collect():
        out[r["i"], r["j"]] = r["cov"]
    return out


@pytest.mark.parametrize("d,tile,slices", [(512, 64, 3), (10, 4, 2), (7, 7, 1), (5, 100, 8)])
def test_equals_numpy(spark, d, tile, slices):
    x = np.random.default_rng(d).normal(50, 3, (200, d))
    got = dense(C.cov_matrix_tiled(array_frame(spark, x), "v", tile=tile, slices=slices), d)
    assert np.allclose(got, np.cov(x.T), rtol=1e-10, atol=1e-10)


def test_columns_names_and_errors(spark):
    x = np.random.default_rng(0).normal(size=(30, 3))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    tiled = C.cov_matrix_tiled(df, ["a", "b", "c"], tile=2)
    plain = {(r["i"], r["j"]): (r["col_i"], r["col_j"], pytest.approx(r["cov"])) for r in
             C.cov_matrix(df, ["a", "b", "c"]).collect()}
    assert {(r["i"], r["j"]): (r["col_i"], r["col_j"], r["cov"]) for r in tiled.collect()} == plain
    one = spark.createDataFrame([([1.0, 2.0],)], "v array<double>")
    with pytest.raises(ValueError, match="more than one row"):
        C.cov_matrix_tiled(one, "v")
    with pytest.raises(ValueError, match="empty"):
        C.cov_matrix_tiled(one.limit(0), "v")
    with pytest.raises(Exception, match="dimensions mismatch"):
        C.cov_matrix_tiled(one.unionByName(spark.createDataFrame([([1.0],)], one.schema)), "v", dim=2)
    with pytest.raises(Exception, match="null value"):
        C.cov_matrix_tiled(one.unionByName(spark.createDataFrame([([1.0, None],)], one.schema)), "v")


def test_shuffled_rows_do_not_follow_the_tasks(spark):
    """The sums that meet are d x d per slice, however many tasks made them."""
    from statframe.plans import tiles

    x = np.random.default_rng(3).normal(size=(64, 12))
    for parts in (2, 16):
        df = array_frame(spark, x, parts).select(F.col("v").alias("x"))
        n, mean, long = tiles.tiled_comoments(df, 12, tile=5, slices=2)
        assert n == 64 and np.allclose(mean, x.mean(axis=0)) and long.count() == 144


@pytest.mark.parametrize("name", ["corr_pearson_wide", "cov_matrix_wide", "cov_matrix_tiled"])
def test_wide_matrices_repeat(spark, name):
    """Ten runs at three partition counts, each against the oracle."""
    con, was, value = duck(SF), spark.conf.get("spark.sql.shuffle.partitions"), name.split("_")[0]
    want = sorted(con.sql(f"SELECT i, j, {value} FROM ({E.oracle_sql()[name]})").fetchall())
    try:
        for i in range(10):
            spark.conf.set("spark.sql.shuffle.partitions", (3, 8, 16)[i % 3])
            got = E.queries()[name](spark, SF).select("i", "j", value).collect()
            assert sorted(map(tuple, got)) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
