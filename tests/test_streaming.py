import math

from pyspark.sql import functions as F

from statframe.operators import summary as S
from statframe.session import scratch_path
from statframe.streaming import abtest as AB
from statframe.streaming import summary as SS


def test_stream_summary_equals_batch_over_slices(spark):
    """events written in three slices and replayed as a file stream."""
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    src = scratch_path(spark, "events-slices")
    for i in range(3):
        ev.filter(F.pmod(F.col("event_id"), F.lit(3)) == i).write.parquet(f"{src}/slice={i}")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1) \
        .parquet(f"{src}/slice=*")
    out, ckpt = scratch_path(spark, "ss-out"), scratch_path(spark, "ss-ckpt")
    SS.run_to_table(stream, ["value"], "ts", "1 day", "30 days", out, ckpt)
    got = {r["window_start"].date(): r for r in
           SS.finalize_windows(SS.latest_windows(spark, out), ["value"]).collect()}
    batch = S.col_summary(ev.withColumn("day", F.to_date("ts")), ["value"], group_by=["day"])
    want = {r["day"]: r for r in batch.collect()}
    assert got.keys() == want.keys()
    for k in want:
        for f in ("count", "mean", "variance", "max", "min", "norm_l2"):
            assert math.isclose(got[k][f], want[k][f], rel_tol=1e-9), (k, f)


def test_windowed_welch(spark):
    from statframe.functions.special import t_two_sided_p

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    stream = spark.readStream.schema(ev.schema).parquet(
        "/root/testdata/sf0.001/event[s].parquet")
    out, ckpt = scratch_path(spark, "ab-out"), scratch_path(spark, "ab-ckpt")
    SS.run_update_stream(AB.windowed_moments(stream, "value", F.col("event_type") == "purchase",
                                             "ts", "30 days", "1 day"), out, ckpt)
    res = AB.t_test(SS.latest_windows(spark, out)).collect()
    assert res
    pdf = ev.toPandas()
    for r in res:
        lo, hi = r["window_start"], r["window_end"]
        w = pdf[(pdf.ts >= lo.replace(tzinfo=None)) & (pdf.ts < hi.replace(tzinfo=None))]
        a = w[w.event_type != "purchase"].value
        b = w[w.event_type == "purchase"].value
        va, vb = a.var() / len(a), b.var() / len(b)
        t = (a.mean() - b.mean()) / math.sqrt(va + vb)
        dof = (va + vb) ** 2 / (va * va / (len(a) - 1) + vb * vb / (len(b) - 1))
        assert math.isclose(r["statistic"], t, rel_tol=1e-9)
        assert math.isclose(r["p_value"], t_two_sided_p(t, dof), rel_tol=1e-9)


def test_late_rows_beyond_watermark_are_dropped(spark):
    """Batches: the last day, the day before, then the first day (29 days late).

    Spark filters late rows against the watermark of the previous batch, so
    the third batch is the first one guaranteed to drop them."""
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    days = ev.select(F.to_date("ts").alias("d")).distinct().orderBy("d").collect()
    first, last = days[0]["d"], days[-1]["d"]
    src = scratch_path(spark, "late-slices")
    ev.filter(F.to_date("ts") == last).coalesce(1).write.parquet(f"{src}/slice=0")
    ev.filter(F.to_date("ts") == days[-2]["d"]).coalesce(1).write.parquet(f"{src}/slice=1")
    ev.filter(F.to_date("ts") == first).coalesce(1).write.parquet(f"{src}/slice=2")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1) \
        .parquet(f"{src}/slice=*")
    out, ckpt = scratch_path(spark, "late-out"), scratch_path(spark, "late-ckpt")
    SS.run_to_table(stream, ["value"], "ts", "1 day", "1 day", out, ckpt)
    got = {r["window_start"].date() for r in
           SS.finalize_windows(SS.latest_windows(spark, out), ["value"]).collect()}
    assert last in got and first not in got


def test_student_pooled_variant(spark):
    from statframe.functions.special import t_two_sided_p

    moments = spark.createDataFrame(
        [((None, None), 5, 1.0, 2.0, 7, 2.5, 1.5)],
        "window struct<start: timestamp, end: timestamp>, n_a long, mean_a double, "
        "var_a double, n_b long, mean_b double, var_b double")
    r = AB.t_test(moments, AB.STUDENT).collect()[0]
    pooled = (4 * 2.0 + 6 * 1.5) / 10
    t = (1.0 - 2.5) / math.sqrt(pooled * (1 / 5 + 1 / 7))
    assert math.isclose(r["statistic"], t, rel_tol=1e-12)
    assert r["degrees_of_freedom"] == 10.0
    assert math.isclose(r["p_value"], t_two_sided_p(t, 10.0), rel_tol=1e-12)
    assert r["method"] == "Student's 2-sample t-test"


def test_append_mode_writes_finished_windows_once(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    days = [r["d"] for r in ev.select(F.to_date("ts").alias("d")).distinct().orderBy("d").collect()]
    src = scratch_path(spark, "append-slices")
    for i, d in enumerate(days[:6]):
        ev.filter(F.to_date("ts") == d).coalesce(1).write.parquet(f"{src}/slice={i}")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1) \
        .parquet(f"{src}/slice=*")
    out, ckpt = scratch_path(spark, "append-out"), scratch_path(spark, "append-ckpt")
    SS.run_to_table(stream, ["value"], "ts", "1 day", "1 hour", out, ckpt, mode="append")
    got = SS.finalize_windows(spark.read.parquet(out), ["value"]).collect()
    emitted = {r["window_start"].date(): r for r in got}
    assert len(got) == len(emitted) and 0 < len(emitted) < 6   # once each; last still open
    batch = {r["day"]: r for r in S.col_summary(ev.withColumn("day", F.to_date("ts")), ["value"],
                                                group_by=["day"]).collect()}
    for d, r in emitted.items():
        assert r["count"] == batch[d]["count"]
        assert math.isclose(r["mean"], batch[d]["mean"], rel_tol=1e-12)


def test_replayed_events_of_years_lose_no_row(spark, tmp_path):
    """Events of 2,500 days, newest and oldest in every file of the replay."""
    from statframe import queries as Q

    days = F.col("id") % 6 * 500 + 1
    spark.range(1200).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(days * 86400 + F.col("id")).alias("ts"),
        F.col("id").alias("user_id"),
        F.when(F.col("id") % 4 < 2, "purchase").otherwise("view").alias("event_type"),
        (F.col("id") % 17).cast("double").alias("value"), F.lit("").alias("props")
    ).write.parquet(f"{tmp_path}/events.parquet")
    got = Q.q_stream_summary(spark, str(tmp_path)).collect()
    assert sorted(r["count"] for r in got) == [200] * 6
    got = Q.q_stream_summary_by_type(spark, str(tmp_path)).collect()
    assert len(got) == 12 and sum(r["count"] for r in got) == 1200
    for q in (Q.q_stream_ab_test, Q.q_stream_ab_test_student):
        got = q(spark, str(tmp_path)).collect()
        assert len(got) == 6
