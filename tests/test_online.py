"""Running state of a stream against the batch results of every prefix."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from statframe.operators import summary as S
from statframe.session import scratch_path
from statframe.streaming import online as ON

KIND = "g string, v double, w double, ts timestamp"


def batches(n=4, rows=60, seed=1):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        pdf = pd.DataFrame({"g": rng.choice(["a", "a", "a", "b", None], rows),
                            "v": rng.normal(5, 2, rows).round(3), "w": rng.choice([0.0, -1.5, np.nan, 3.0], rows)})
        pdf["ts"] = pd.Timestamp("2024-01-01") + pd.to_timedelta(i * 3600 + np.arange(rows), unit="s")
        out.append(pdf)
    return out


def write(spark, pdf, folder, i):
    rows = [(g, float(v), float(w), ts.to_pydatetime()) for g, v, w, ts in pdf.itertuples(index=False)]
    spark.createDataFrame(rows, KIND).repartition(3).write.mode("append").option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{folder}/f{i}")


def stream(spark, folder):
    return spark.readStream.schema(KIND).option("maxFilesPerTrigger", 3).parquet(f"{folder}/*")


def rows_of(df):
    return sorted(str([round(v, 8) if isinstance(v, float) else v for v in r]) for r in df.collect())


def test_every_prefix_and_a_restart(spark):
    folder, out, ckpt = (scratch_path(spark, x) for x in ("in", "out", "ckpt"))
    parts = batches()
    for i in (0, 1):
        write(spark, parts[i], folder, i)
        ON.run_running(ON.running_state(stream(spark, folder), ["v", "w"], ["g"]), out, ckpt)
    for i in (2, 3):  # a new query on the old checkpoint
        write(spark, parts[i], folder, i)
        ON.run_running(ON.running_state(stream(spark, folder), ["v", "w"], ["g"]), out, ckpt)
    for k in range(4):
        so_far = spark.read.schema(KIND).parquet(*[f"{folder}/f{i}" for i in range(k + 1)])
        want = rows_of(S.col_summary(so_far, ["v", "w"], group_by=["g"]))
        assert rows_of(ON.running_summary(spark, out, ["g"], upto=k)) == want
    assert rows_of(ON.running_summary(spark, out, ["g"])) == want


def test_without_groups(spark):
    folder, out, ckpt = (scratch_path(spark, x) for x in ("in", "out", "ckpt"))
    write(spark, batches()[0], folder, 0)
    ON.run_running(ON.running_state(stream(spark, folder), ["v"], salts=1), out, ckpt)
    want = S.col_summary(spark.read.schema(KIND).parquet(f"{folder}/*"), ["v"])
    assert rows_of(ON.running_summary(spark, out)) == rows_of(want)


def test_expired_state_is_begun_again(spark):
    """Rows days after a group's expiry add to what the output has of it."""
    folder, out, ckpt = (scratch_path(spark, x) for x in ("in", "out", "ckpt"))
    parts = batches(3)
    for i, pdf in enumerate(parts):
        pdf["ts"] += pd.Timedelta(days=3 * i)
        write(spark, pdf, folder, i)
        ON.run_running(ON.running_state(stream(spark, folder), ["v"], ["g"], "ts", "1 hour",
                                        expire_after=3600.0), out, ckpt)
    lives = spark.read.parquet(out).filter("g = 'a'").select("life").distinct().count()
    assert lives >= 2
    want = S.col_summary(spark.read.schema(KIND).parquet(f"{folder}/*"), ["v"], group_by=["g"])
    assert rows_of(ON.running_summary(spark, out, ["g"])) == rows_of(want)


def test_refusals(spark):
    s = spark.readStream.format("rate").load().select(F.col("value").cast("double").alias("v"),
                                                      F.lit("x").alias("salt"))
    with pytest.raises(ValueError, match="salt"):
        ON.running_state(s, ["v"], ["salt"])
    with pytest.raises(ValueError, match="watermark"):
        ON.running_state(s, ["v"], expire_after=5.0)
    with pytest.raises(ValueError, match="unknown test method"):
        ON.cumulative_test(spark, "nowhere", "e", "other")


def test_cumulative_welch(spark):
    """Each prefix of the stream against pandas, the first half hour left out."""
    folder, out, ckpt = (scratch_path(spark, x) for x in ("in", "out", "ckpt"))
    parts = batches(3, 90, seed=4)
    starts = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("b", "2024-01-01 00:00:20")],
                                   "g string, start string")
    treated = F.pmod(F.second("ts"), F.lit(3)) == 0
    for i, pdf in enumerate(parts):
        write(spark, pdf, folder, i)
        late = ON.after_start_up(stream(spark, folder), starts, "g", "ts", "30 seconds")
        ON.run_running(ON.cumulative_moments(late, "v", treated, "g"), out, ckpt)
    for k in range(3):
        x = pd.concat(parts[:k + 1])
        from_ = x["g"].map({"a": pd.Timestamp("2024-01-01 00:00:30"), "b": pd.Timestamp("2024-01-01 00:00:50")})
        x = x[x["ts"] >= from_]
        got = {r["g"]: r for r in ON.cumulative_test(spark, out, "g", upto=k).collect()}
        assert set(got) == set(x["g"])
        for g, y in x.groupby("g"):
            t = y["ts"].dt.second % 3 == 0
            a, b = y["v"][~t], y["v"][t]
            sa, sb = a.var() / len(a), b.var() / len(b)
            assert (got[g]["n_a"], got[g]["n_b"]) == (len(a), len(b))
            assert got[g]["statistic"] == pytest.approx((a.mean() - b.mean()) / np.sqrt(sa + sb))
            assert got[g]["degrees_of_freedom"] == pytest.approx(
                (sa + sb) ** 2 / (sa ** 2 / (len(a) - 1) + sb ** 2 / (len(b) - 1)))
            assert 0 <= got[g]["p_value"] <= 1
