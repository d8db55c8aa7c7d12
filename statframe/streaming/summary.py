"""Column summaries over a stream (S13): the online use of the summarizer,
re-aimed at Structured Streaming.

Event-time windows are aggregated into the mergeable summary state with
built-in streaming aggregates (count, avg, var_pop, sums, max, min); a
watermark bounds the state.  Rows later than the watermark are dropped from
the micro-batch after the one that moved the watermark past them (Spark
checks late rows against the previous batch's watermark); rows within the
delay are always counted.  The
state is finalized by the same projection as the batch summary, so a
replayed stream gives the batch result per window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statframe.functions.columns import apply_null_policy, join_keys, not_null
from statframe.operators.summary import _common_aggs, _unpivot, finalize


def event_time(stream: DataFrame, time_col: str) -> DataFrame:
    """Watermarks need TIMESTAMP; a TIMESTAMP_NTZ column is read as wall-clock
    time in the session time zone."""
    if stream.schema[time_col].dataType.typeName() == "timestamp_ntz":
        return stream.withColumn(time_col, F.col(time_col).cast("timestamp"))
    return stream


def windowed_state(stream: DataFrame, cols: Sequence[str], time_col: str, window: str,
                   watermark: str, group_by: Sequence[str] = (), nulls: str = "error"
                   ) -> DataFrame:
    """Wide per-window state (streaming-safe: aggregates only); nulls as in the batch form:
    an error, or rows dropped."""
    cols = list(cols)
    keys = list(group_by)
    stream = apply_null_policy(stream, cols, nulls)
    data = event_time(stream, time_col).withWatermark(time_col, watermark).select(
        F.window(time_col, window).alias("window"), *keys,
        *[not_null(F.col(c).cast("double"), c).alias(f"_x{i}") for i, c in enumerate(cols)])
    aggs = [F.count(F.lit(1)).alias("n")]
    for i in range(len(cols)):
        x = F.col(f"_x{i}")
        aggs += [F.avg(x).alias(f"mean_{i}"), (F.var_pop(x) * F.count(x)).alias(f"m2_{i}")]
        aggs += _common_aggs(i, None)
    return data.groupBy("window", *keys).agg(*aggs)


def finalize_windows(wide: DataFrame, cols: Sequence[str], group_by: Sequence[str] = ()
                     ) -> DataFrame:
    """Wide window state (a batch of the sink) -> summary rows per window."""
    keys = ["window_start", "window_end", *group_by]
    wide = (wide.withColumn("window_start", F.col("window.start"))
            .withColumn("window_end", F.col("window.end"))
            .withColumn("w_sum", F.col("n").cast("double"))
            .withColumn("w2_sum", F.col("n").cast("double")))
    state = _unpivot(wide, keys, list(cols), {"n": "n", "w_sum": "w_sum", "w2_sum": "w2_sum"})
    return finalize(state, keys)


def run_update_stream(state: DataFrame, out_path: str, checkpoint: str) -> None:
    """Run a windowed streaming aggregate over everything available now.

    Update mode with ``foreachBatch``: every micro-batch writes the windows it
    changed under its own ``batch_id=<n>`` folder; the latest version of each
    window is its final state (``latest_windows``).  A retried batch
    overwrites its own folder, so delivery is idempotent, and the query's
    checkpoint lets a restarted job resume where it stopped.
    """
    def sink(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    q = (state.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def run_append_stream(state: DataFrame, out_path: str, checkpoint: str,
                      available_now: bool = True):
    """Append mode into a Parquet sink: each window is written once, after the
    watermark passes its end — the mode for an unbounded stream.  The file
    sink's log makes the output exactly-once.  Windows still open when a
    bounded replay ends are not written."""
    w = (state.writeStream.outputMode("append").format("parquet")
         .option("path", out_path).option("checkpointLocation", checkpoint))
    q = w.trigger(availableNow=True).start() if available_now else w.start()
    if available_now:
        q.awaitTermination()
    return q


def run_to_table(stream: DataFrame, cols: Sequence[str], time_col: str, window: str,
                 watermark: str, out_path: str, checkpoint: str,
                 group_by: Sequence[str] = (), mode: str = "update",
                 nulls: str = "error") -> None:
    """Windowed summary state of ``stream`` written to ``out_path``
    (``mode`` "update": every version, read with ``latest_windows``;
    "append": finished windows only, read the folder directly)."""
    state = windowed_state(stream, cols, time_col, window, watermark, group_by, nulls)
    if mode == "append":
        run_append_stream(state, out_path, checkpoint)
    elif mode == "update":
        run_update_stream(state, out_path, checkpoint)
    else:
        raise ValueError(f"mode must be 'update' or 'append', got {mode!r}")


def latest_windows(spark, out_path: str, group_by: Sequence[str] = ()) -> DataFrame:
    """Last emitted version of each window from ``run_to_table``'s output."""
    keys = ["window", *group_by]
    raw = spark.read.parquet(out_path)
    last = raw.groupBy(*keys).agg(F.max("batch_id").alias("batch_id"))
    return join_keys(raw, last, [*keys, "batch_id"]).drop("batch_id")
