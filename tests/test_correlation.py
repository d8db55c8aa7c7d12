import math
import random

import pytest
from pyspark.sql import functions as F

from statframe.operators import correlation as C
from statframe.operators import rank as R


def matrix(df):
    out = {}
    for r in df.collect():
        out[(r["i"], r["j"])] = r["corr"]
    return out


def test_f5_constant_column_nan_diag_one(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "a double, b double")
    m = matrix(C.corr(df, ["a", "b"]))
    assert m[(0, 0)] == 1.0 and m[(1, 1)] == 1.0
    assert math.isnan(m[(0, 1)]) and math.isnan(m[(1, 0)])


def test_near_zero_variance_is_zero(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0 + 1e-7, 2.0), (1.0, 3.0)], "a double, b double")
    assert math.isnan(matrix(C.corr(df, ["a", "b"]))[(0, 1)])


def test_f6_spearman(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, -1.0), (2.0, 0.0)], "a double, b double")
    m = matrix(C.corr(df, ["a", "b"], "spearman"))
    assert math.isclose(m[(0, 1)], -0.5, rel_tol=1e-12)
    assert m[(0, 0)] == 1.0


def test_f7_average_rank(spark):
    df = spark.createDataFrame([(10.0,), (20.0,), (20.0,), (30.0,)], "x double")
    got = sorted(r["x_rank"] for r in R.avg_rank(df, ["x"]).collect())
    assert got == [0.0, 1.5, 1.5, 3.0]


def test_rank_partition_count_invariant(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    a = R.value_ranks(li, ["l_extendedprice", "l_discount"], partitions=1)
    b = R.value_ranks(li, ["l_extendedprice", "l_discount"], partitions=8)
    c = R.value_ranks(li, ["l_extendedprice", "l_discount"])  # AQE-sized range split
    ka = sorted((r["column"], r["value"], r["avg_rank"]) for r in a.collect())
    kb = sorted((r["column"], r["value"], r["avg_rank"]) for r in b.collect())
    kc = sorted((r["column"], r["value"], r["avg_rank"]) for r in c.collect())
    assert ka == kb == kc


def test_rank_rejects_nan(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    with pytest.raises(Exception, match="NaN"):
        R.avg_rank(df, ["x"]).collect()


def test_method_name(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0)], "a double, b double")
    with pytest.raises(ValueError, match="pearson, spearman"):
        C.corr(df, ["a", "b"], "Pearson")


def test_cov_needs_two_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    with pytest.raises(Exception, match="more than one row"):
        C.cov_matrix(df, ["a", "b"]).collect()


def test_matches_builtin_pearson_and_spearman(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    vec = VectorAssembler(inputCols=cols, outputCol="v").transform(li)
    for method in ("pearson", "spearman"):
        ref = Correlation.corr(vec, "v", method).collect()[0][0].toArray()
        ours = matrix(C.corr(li, cols, method))
        for (i, j), v in ours.items():
            assert math.isclose(v, ref[i][j], rel_tol=1e-9, abs_tol=1e-12), (method, i, j)


def test_spearman_invariant_under_monotone_map(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(
        "l_quantity", "l_extendedprice")
    mapped = li.select(F.exp(F.col("l_quantity") / 10).alias("l_quantity"),
                       (F.col("l_extendedprice") * 3 - 7).alias("l_extendedprice"))
    a = matrix(C.corr(li, ["l_quantity", "l_extendedprice"], "spearman"))
    b = matrix(C.corr(mapped, ["l_quantity", "l_extendedprice"], "spearman"))
    assert math.isclose(a[(0, 1)], b[(0, 1)], rel_tol=1e-12)


def test_wide_blocked_comoments_match_unrolled(spark):
    from statframe.plans import gram

    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    cols = [F.col("embedding")[i].cast("double") for i in range(40)]
    wide = {(r["i"], r["j"]): r["value"] for r in gram.comoments(emb, cols).collect()}
    small = {(r["i"], r["j"]): r["value"] for r in gram.comoments(emb, cols[:3]).collect()}
    for k, v in small.items():
        assert math.isclose(wide[k], v, rel_tol=1e-9, abs_tol=1e-12)


def test_to_matrix(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, 5.0)], "a double, b double")
    m, names = C.to_matrix(C.corr(df, ["a", "b"]))
    assert names == ["a", "b"] and m.shape == (2, 2) and m[0, 0] == 1.0
    assert math.isclose(m[0, 1], m[1, 0])


def test_spearman_long_form_equals_per_column(spark, monkeypatch):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    per_column = matrix(C.corr(li, cols, "spearman"))
    monkeypatch.setattr(R, "BROADCAST_ROWS", 0)  # every column "too big": long form
    generated = matrix(C.spearman(li, cols))
    keyed = matrix(C.spearman(li.withColumn("k", F.monotonically_increasing_id()), cols,
                              row_key="k"))
    for k, v in per_column.items():
        assert math.isclose(generated[k], v, rel_tol=1e-12)
        assert math.isclose(keyed[k], v, rel_tol=1e-12)


def test_spearman_long_form_deals_ties_out(spark, monkeypatch):
    """Values that own many rows are not brought together in the join with the ranks."""
    rng = random.Random(9)
    df = spark.createDataFrame([(float(rng.choice([0, 0, 0, 1, i])), float(i % 2), float(rng.randrange(90)))
                                for i in range(300)], "x double, y double, z double")
    plans, comoments = [], C.comoments
    monkeypatch.setattr(C, "comoments", lambda d, e: plans.append(
        d._jdf.queryExecution().optimizedPlan().toString()) or comoments(d, e))
    for ties in (20, 1 << 16):  # ties above and below; none above
        monkeypatch.setattr(C, "TIED_ROWS", ties)
        got, want = ({(r["i"], r["j"]): r["corr"] for r in C.spearman(
            df, ["x", "y", "z"], long_form=f).collect()} for f in (True, False))
        assert got == pytest.approx(want, abs=1e-12)
    assert "LeftAnti" in plans[0] and "strategy=broadcast" in plans[0]
