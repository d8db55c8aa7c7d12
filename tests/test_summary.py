import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statframe.operators import summary as S

FIELDS = ["count", "mean", "variance", "num_nonzeros", "max", "min", "norm_l1", "norm_l2"]


def by_column(df):
    return {r["column"]: r for r in df.collect()}


def close(a, b, tol=1e-9):
    return all(math.isclose(x, y, rel_tol=tol, abs_tol=tol) for x, y in zip(a, b))


def test_f1_plain(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, -1.0), (2.0, 0.0)], "a double, b double")
    out = by_column(S.col_summary(df, ["a", "b"]))
    a, b = out["a"], out["b"]
    assert a["count"] == 3
    assert close([a["mean"], b["mean"]], [5 / 3, -1 / 3])
    assert close([a["variance"], b["variance"]], [1 / 3, 1 / 3])
    assert [a["num_nonzeros"], b["num_nonzeros"]] == [3.0, 1.0]
    assert [a["max"], b["max"]] == [2.0, 0.0]
    assert [a["min"], b["min"]] == [1.0, -1.0]
    assert [a["norm_l1"], b["norm_l1"]] == [5.0, 1.0]
    assert close([a["norm_l2"], b["norm_l2"]], [3.0, 1.0])


def test_f2_weighted(spark):
    df = spark.createDataFrame([(1.0, -2.0, 2.0), (0.0, -4.0, 1.0), (3.0, -6.0, 0.5),
                                (9.0, 9.0, 0.0)], "a double, b double, w double")
    out = by_column(S.col_summary(df, ["a", "b"], weight="w"))
    a, b = out["a"], out["b"]
    assert a["count"] == 3
    assert close([a["mean"], b["mean"]], [1.0, -3.142857142857143])
    assert close([a["variance"], b["variance"]], [1.5, 3.7142857142857144])
    assert [a["num_nonzeros"], b["num_nonzeros"]] == [2.5, 3.5]
    assert [a["max"], b["max"]] == [3.0, -2.0]
    assert [a["min"], b["min"]] == [0.0, -6.0]
    assert close([a["norm_l1"], b["norm_l1"]], [3.5, 11.0])
    assert close([a["norm_l2"], b["norm_l2"]], [2.5495097567963922, 6.48074069840786])


def test_f3_nan_skipped_in_max_min(spark):
    df = spark.createDataFrame([(float("nan"), -2.0), (-1.0, 0.0)], "a double, b double")
    out = by_column(S.col_summary(df, ["a", "b"]))
    assert [out["a"]["max"], out["b"]["max"]] == [-1.0, 0.0]
    assert [out["a"]["min"], out["b"]["min"]] == [-1.0, -2.0]
    assert [out["a"]["num_nonzeros"], out["b"]["num_nonzeros"]] == [2.0, 1.0]
    assert math.isnan(out["a"]["mean"])


def test_f4_one_row_variance_zero(spark):
    df = spark.createDataFrame([(5.0,)], "a double")
    assert by_column(S.col_summary(df, ["a"]))["a"]["variance"] == 0.0


def test_all_nan_column_keeps_extreme_start(spark):
    df = spark.createDataFrame([(float("nan"),), (float("nan"),)], "a double")
    r = by_column(S.col_summary(df, ["a"]))["a"]
    assert r["max"] == -S.DOUBLE_MAX and r["min"] == S.DOUBLE_MAX


def test_errors(spark):
    neg = spark.createDataFrame([(1.0, -1.0)], "a double, w double")
    with pytest.raises(Exception, match="has to be >= 0"):
        S.col_summary(neg, ["a"], weight="w").collect()
    empty = spark.createDataFrame([], "a double")
    with pytest.raises(Exception, match="empty input"):
        S.col_summary(empty, ["a"]).collect()
    nulls = spark.createDataFrame([(1.0,), (None,)], "a double")
    with pytest.raises(Exception, match="null value"):
        S.col_summary(nulls, ["a"]).collect()
    assert by_column(S.col_summary(nulls, ["a"], nulls="drop"))["a"]["count"] == 1


def test_array_input_width_check(spark):
    df = spark.createDataFrame([([1.0, 0.0],), ([2.0, -1.0],), ([2.0, 0.0],)], "v array<double>")
    out = by_column(S.col_summary(df, "v"))
    assert out["v[1]"]["min"] == -1.0
    bad = spark.createDataFrame([([1.0, 0.0],), ([2.0],)], "v array<double>")
    with pytest.raises(Exception, match="dimensions mismatch"):
        S.col_summary(bad, "v", dim=2).collect()


def test_sparse_equals_dense(spark):
    dense = spark.createDataFrame([(0, 1.0, 0.0), (1, 0.0, -2.0), (2, 0.0, 0.0), (3, 4.0, 0.5)],
                                  "rid int, a double, b double")
    cells = dense.select("rid", F.inline(F.array(
        F.struct(F.lit(0).alias("idx"), F.col("a").alias("value")),
        F.struct(F.lit(1).alias("idx"), F.col("b").alias("value"))))).filter("value != 0")
    sp = by_column(S.sparse_summary(cells, row_id="rid", num_rows=4))
    dn = by_column(S.col_summary(dense, ["a", "b"]))
    for sname, dname in (("x[0]", "a"), ("x[1]", "b")):
        assert close([sp[sname][f] for f in FIELDS], [dn[dname][f] for f in FIELDS])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.floats(-100, 100), st.floats(0.1, 5)),
                min_size=2, max_size=40))
def test_merge_of_slices_equals_whole(spark, data):
    df = spark.createDataFrame(data, "g int, x double, w double")
    whole = by_column(S.col_summary(df, ["x"], weight="w"))["x"]
    merged = by_column(S.finalize(S.merge_states(
        S.summary_state(df, ["x"], weight="w", group_by=["g"]))))["x"]
    for f in FIELDS:
        assert math.isclose(whole[f], merged[f], rel_tol=1e-9, abs_tol=1e-7), f


def test_matches_builtin_summarizer_unweighted(spark):
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.stat import Summarizer

    data = [(1.0, 0.0), (2.0, -1.0), (2.0, 0.0), (7.5, 3.0)]
    vec = spark.createDataFrame([(Vectors.dense(r),) for r in data], ["features"])
    s = vec.select(Summarizer.metrics("mean", "variance", "normL1", "normL2", "max", "min")
                   .summary(vec.features).alias("s")).collect()[0]["s"]
    ours = by_column(S.col_summary(spark.createDataFrame(data, "a double, b double"), ["a", "b"]))
    for i, c in enumerate("ab"):
        assert math.isclose(ours[c]["mean"], s["mean"][i], rel_tol=1e-12)
        assert math.isclose(ours[c]["variance"], s["variance"][i], rel_tol=1e-12)
        assert math.isclose(ours[c]["norm_l2"], s["normL2"][i], rel_tol=1e-12)
        assert ours[c]["max"] == s["max"][i] and ours[c]["min"] == s["min"][i]


def test_null_group_key_is_a_group(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), (None, 2.0, 1.0), (None, 4.0, 3.0)],
                               "g string, x double, w double")
    out = {r["g"]: r for r in S.col_summary(df, ["x"], weight="w", group_by=["g"]).collect()}
    assert set(out) == {"a", None}
    assert math.isclose(out[None]["mean"], 3.5)
    merged = {r["g"]: r for r in S.finalize(S.merge_states(
        S.summary_state(df, ["x"], group_by=["g", "x"]), ["g"]), ["g"]).collect()}
    assert merged[None]["count"] == 2 and math.isclose(merged[None]["variance"], 2.0)


def test_wide_task_states_equal_unrolled(spark, monkeypatch):
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    emb = emb.withColumn("w", (F.col("vec_id") % 3).cast("double"))
    for weight in (None, "w"):
        wide = by_column(S.col_summary(emb, "embedding", weight=weight, group_by=[]))
        monkeypatch.setattr(S, "WIDE_MIN", 10**9)
        narrow = by_column(S.col_summary(emb, "embedding", weight=weight))
        monkeypatch.setattr(S, "WIDE_MIN", 24)
        assert wide.keys() == narrow.keys()
        for c in wide:
            for f in FIELDS:
                assert math.isclose(wide[c][f], narrow[c][f], rel_tol=1e-9, abs_tol=1e-12), (c, f)
    for weight in (None, "w"):
        key = lambda r: (r["label"], r["column"])
        wide = {key(r): r for r in
                S.col_summary(emb, "embedding", weight=weight, group_by=["label"]).collect()}
        monkeypatch.setattr(S, "WIDE_MIN", 10**9)
        narrow = {key(r): r for r in
                  S.col_summary(emb, "embedding", weight=weight, group_by=["label"]).collect()}
        monkeypatch.setattr(S, "WIDE_MIN", 24)
        assert wide.keys() == narrow.keys()
        assert len(wide) == 64 * emb.select("label").distinct().count()
        for k in wide:
            for f in FIELDS:
                assert math.isclose(wide[k][f], narrow[k][f], rel_tol=1e-9, abs_tol=1e-12), (k, f)


def test_many_group_rollup_equals_direct(spark):
    """Per-(user, day) states merged to users = direct per-user summaries."""
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").withColumn(
        "day", F.to_date("ts"))
    merged = {r["user_id"]: r for r in S.finalize(S.merge_states(
        S.summary_state(ev, ["value"], group_by=["user_id", "day"]), ["user_id"]),
        ["user_id"]).collect()}
    direct = {r["user_id"]: r for r in S.col_summary(ev, ["value"], group_by=["user_id"]).collect()}
    assert merged.keys() == direct.keys() and len(direct) > 100
    for k in direct:
        for f in FIELDS:
            assert math.isclose(merged[k][f], direct[k][f], rel_tol=1e-12), (k, f)


def test_grouped_sparse_equals_dense(spark):
    dense = spark.createDataFrame(
        [("g1", 0, 1.0, 0.0), ("g1", 1, 0.0, -2.0), ("g1", 2, 0.0, 0.0),
         ("g2", 3, 4.0, 0.5), ("g2", 4, 2.0, 0.0)], "g string, rid int, a double, b double")
    cells = dense.select("g", "rid", F.inline(F.array(
        F.struct(F.lit(0).alias("idx"), F.col("a").alias("value")),
        F.struct(F.lit(1).alias("idx"), F.col("b").alias("value"))))).filter("value != 0")
    rows = dense.groupBy("g").agg(F.count(F.lit(1)).alias("_rows"))
    sp = {(r["g"], r["column"]): r for r in
          S.sparse_summary(cells, row_id="rid", num_rows=rows, group_by=["g"]).collect()}
    dn = {(r["g"], r["column"]): r for r in S.col_summary(dense, ["a", "b"], group_by=["g"]).collect()}
    for g in ("g1", "g2"):
        for sname, dname in (("x[0]", "a"), ("x[1]", "b")):
            assert close([sp[(g, sname)][f] for f in FIELDS], [dn[(g, dname)][f] for f in FIELDS])


def grouped_wide(spark, d=64, n=300):
    import numpy as np

    rng = np.random.default_rng(7)
    x = rng.normal(10, 3, (n, d)) * (rng.random((n, d)) < 0.7)
    x[5, 3], x[6, 4] = float("nan"), float("inf")
    keys = rng.choice(["a", "a", "a", "b", "c", None], n)
    rows = [(k, float(rng.choice([1.0, 2.0, float("nan")])), float(rng.random()), r.tolist())
            for k, r in zip(keys, x)]
    return spark.createDataFrame(rows, "g string, h double, w double, v array<double>").repartition(6)


@pytest.mark.parametrize("weight", [None, "w"])
@pytest.mark.parametrize("keys", [["g"], ["g", "h"]])
def test_grouped_wide_states_equal_the_narrow_path(spark, monkeypatch, weight, keys):
    df = grouped_wide(spark)
    wide = S.col_summary(df, "v", weight=weight, group_by=keys, dim=64)
    got = {tuple(str(r[k]) for k in (*keys, "column")): r for r in wide.collect()}
    monkeypatch.setattr(S, "WIDE_MIN", 10 ** 6)
    parts = [S.col_summary(df.select(*keys, "w", *[F.col("v")[i].alias(f"v[{i}]") for i in js]),
                           [f"v[{i}]" for i in js], weight=weight, group_by=keys)
             for js in (range(0, 8), range(60, 64))]
    for r in (r for p in parts for r in p.collect()):
        mine = got[tuple(str(r[k]) for k in (*keys, "column"))]
        for f in FIELDS:
            assert (math.isnan(r[f]) and math.isnan(mine[f])) or r[f] == mine[f] or math.isclose(
                r[f], mine[f], rel_tol=1e-9, abs_tol=1e-9), (f, r, mine)


def test_grouped_wide_states_are_few_rows(spark):
    """At most tasks x groups x columns rows leave the tasks."""
    df = spark.range(0, 20_000, 1, 4).select((F.col("id") % 3).alias("g"), F.array(*[
        (F.col("id") + i).cast("double") for i in range(30)]).alias("v"))
    data, names, keys = S._prepare(df, "v", None, ["g"], "error", 30)
    assert S._group_states(data, names, keys, False).count() <= 4 * 3 * 30


@pytest.mark.parametrize("cols", [["x"], "v"])
def test_any_names(spark, cols):
    """Dots in names; a group column that the result could not tell apart is refused."""
    df = spark.createDataFrame([(1.0, "k", [1.0] * 30), (3.0, "k", [2.0] * 30)], "x double, g string, v array<double>")
    odd = df.withColumnRenamed("x", "a.b").withColumnRenamed("v", "c.d").withColumnRenamed("g", "e.f")
    mine = ["a.b"] if cols == ["x"] else "c.d"
    got = S.col_summary(odd, mine, group_by=["e.f"]).collect()
    want = S.col_summary(df, cols, group_by=["g"]).collect()
    assert sorted(r["mean"] for r in got) == sorted(r["mean"] for r in want)
    assert {r["e.f"] for r in got} == {"k"} and got[0]["column"].startswith(mine[0] if cols == ["x"] else mine)
    with pytest.raises(ValueError, match="rename the group column 'column'"):
        S.col_summary(df.withColumnRenamed("g", "column"), cols, group_by=["column"])


def test_rank_names(spark):
    from statframe.operators import rank as R

    df = spark.createDataFrame([(3.0, "p", 1), (1.0, "q", 2)], "x double, _rk0 string, `a.b` int")
    got = R.avg_rank(df, ["x", "a.b"])
    assert got.columns == ["x", "_rk0", "a.b", "x_rank", "a.b_rank"]
    assert sorted(got.collect()) == [(1.0, "q", 2, 0.0, 1.0), (3.0, "p", 1, 1.0, 0.0)]
    with pytest.raises(ValueError, match="two columns named x_rank"):
        R.avg_rank(df.withColumnRenamed("_rk0", "x_rank"), ["x"])
