"""Running summaries and tests over a stream: state of all rows so far, without windows.

Each group keeps a mergeable state (the fields of ``operators.summary``) in Spark's state store, through
``applyInPandasWithState``: a micro-batch's rows are folded into it and the new state is emitted, one
row per column.  A group is kept in up to ``salts`` parts, dealt by input partition, so that a
group with a third of all rows is not one task's; the parts are merged when they are read.  State
lives in the query's checkpoint: a restarted query goes on where it stopped.  With ``expire_after`` a part
that has seen no row for so long (event time, past the watermark) leaves the store; its last row in the
output stays, and later rows start a new part, told apart by its first event time, that adds to it.

``run_running`` writes each micro-batch's changes to its own folder, so that a retried batch
overwrites itself, and ``running_states(upto=k)`` reads the state after batch k.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statframe.functions.columns import apply_null_policy, named, not_null, quoted
from statframe.operators.summary import (STATE_FIELDS, _batch_states, _GroupStates, finalize,
                                         merge_states)
from statframe.ship import ship
from statframe.streaming.abtest import METHOD_NAMES, WELCH, test_columns
from statframe.streaming.summary import event_time

SALTS = 8

_FIELDS = ("n long, w_sum double, w2_sum double, mean double, m2 double, nnz double, n_zero long, "
           "max_nz double, min_nz double, norm_l1 double, l2_sq double")
_ARRAYS = ("mean", "m2", "nnz", "zero", "seen", "mx", "mn", "l1", "l2")
_KINDS = {"zero": "array<bigint>", "seen": "array<boolean>"}


def running_state(stream: DataFrame, cols: Sequence[str], group_by: Sequence[str] = (),
                  time_col: str | None = None, watermark: str | None = None,
                  expire_after: float | None = None, salts: int = SALTS, nulls: str = "error"
                  ) -> DataFrame:
    """The state of every group that a micro-batch changed: (group..., salt, life, column, state
    fields).  ``expire_after`` (seconds) needs ``time_col`` and ``watermark``; ``life`` is the event time
    (ms) at which the part was begun."""
    ship(stream.sparkSession)
    cols, keys = list(cols), list(group_by)
    clash = sorted(set(keys) & {"column", "salt", "life", *STATE_FIELDS})
    if clash:
        raise ValueError(f"rename the group column {clash[0]!r}: the result has a column of this name")
    expires = expire_after is not None
    if expires and not (time_col and watermark):
        raise ValueError("expire_after needs time_col and watermark")
    stream = apply_null_policy(stream, cols, nulls)
    if watermark:
        stream = event_time(stream, time_col).withWatermark(time_col, watermark)
    data = stream.select(
        *[named(stream, k).alias(f"k{i}") for i, k in enumerate(keys)],
        F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"),
        *([F.col(time_col), F.unix_millis(time_col).alias("ms")] if watermark else []),
        F.array(*[not_null(named(stream, c).cast("double"), c) for c in cols]).alias("x"))
    kinds = [data.schema[f"k{i}"].dataType.simpleString() for i in range(len(keys))]
    key_schema = "".join(f"k{i} {t}, " for i, t in enumerate(kinds))
    d = len(cols)

    def fold(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held, newest, life, first = _GroupStates(d), None, None, None
        if state.exists:
            newest, life, n, w, w2, *arrays = state.get
            part = {"n": np.array([n]), "w": np.array([w]), "w2": np.array([w2])}
            for f, v in zip(_ARRAYS, arrays):
                part[f] = np.array([v], dtype={"zero": np.int64, "seen": bool}.get(f, np.float64))
            held.add([0], part)
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["x"].to_list()).astype(np.float64)
                held.add([0], _batch_states(x, np.ones(len(x)), np.zeros(len(x), np.int64), 1))
                if watermark:
                    lo, hi = int(pdf["ms"].min()), int(pdf["ms"].max())
                    newest = hi if newest is None else max(newest, hi)
                    first = lo if first is None else min(first, lo)
        if life is None:
            life = first if watermark else 0
        p = held.part
        state.update((newest, life, int(p["n"][0]), float(p["w"][0]), float(p["w2"][0]),
                      *[p[f][0].tolist() for f in _ARRAYS]))
        if expires:
            at = newest + int(expire_after * 1000)
            state.setTimeoutTimestamp(max(at, state.getCurrentWatermarkMs() + 1))
        seen = p["seen"][0]
        yield pd.DataFrame({
            **{f"k{i}": pd.Series([v] * d) for i, v in enumerate(key[:-1])},
            "salt": np.full(d, key[-1], np.int32), "life": np.full(d, life, np.int64),
            "column": cols, "n": int(p["n"][0]), "w_sum": p["w"][0], "w2_sum": p["w2"][0],
            "mean": p["mean"][0], "m2": p["m2"][0], "nnz": p["nnz"][0],
            "n_zero": p["zero"][0],
            "max_nz": pd.Series(p["mx"][0]).astype("Float64").where(pd.Series(seen), pd.NA),
            "min_nz": pd.Series(p["mn"][0]).astype("Float64").where(pd.Series(seen), pd.NA),
            "norm_l1": p["l1"][0], "l2_sq": p["l2"][0]})

    stored = "newest long, life long, n long, w double, w2 double, " + ", ".join(
        f"{f} {_KINDS.get(f, 'array<double>')}" for f in _ARRAYS)
    out = data.groupBy(*[f"k{i}" for i in range(len(keys))], "salt").applyInPandasWithState(
        fold, f"{key_schema}salt int, life long, `column` string, {_FIELDS}", stored, "update",
        "EventTimeTimeout" if expires else "NoTimeout")
    # a NaN comes back from pandas as a null; only the extremes are null when there is none
    fields = [F.col(f) if f in ("max_nz", "min_nz") else F.coalesce(F.col(f), F.lit(float("nan"))).alias(f)
              if f not in ("n", "n_zero") else F.col(f) for f in STATE_FIELDS]
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "salt", "life",
                      "column", *fields)


def run_running(state: DataFrame, out_path: str, checkpoint: str) -> None:
    """Fold everything that is available now; every micro-batch writes what it changed."""
    def sink(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    state.writeStream.outputMode("update").foreachBatch(sink).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def running_states(spark, out_path: str, group_by: Sequence[str] = (), upto: int | None = None
                   ) -> DataFrame:
    """The state per group and column after micro-batch ``upto`` (None: the last one)."""
    raw = spark.read.parquet(out_path)
    if upto is not None:
        raw = raw.filter(F.col("batch_id") <= upto)
    keys = [quoted(k) for k in (*group_by, "salt", "life", "column")]
    last = raw.groupBy(*keys).agg(F.max_by(F.struct(*STATE_FIELDS), "batch_id").alias("s")).select(
        *[quoted(k) for k in group_by], "column", "s.*")
    return merge_states(last, group_by)


def running_summary(spark, out_path: str, group_by: Sequence[str] = (), upto: int | None = None
                    ) -> DataFrame:
    """Summary rows of all rows so far."""
    return finalize(running_states(spark, out_path, group_by, upto), group_by)


# ------------------------------------------------------------ cumulative tests

def after_start_up(stream: DataFrame, starts: DataFrame, experiment: str, time_col: str,
                   period: str, start_col: str = "start") -> DataFrame:
    """The rows of experiments that ``starts (experiment, start)`` lists, from ``period`` (an interval such
    as ``1 day``) after their start on: what a new experiment does at first is left out."""
    begin = starts.select(quoted(experiment), (F.col(start_col).cast("timestamp") + F.expr(
        f"INTERVAL {period}")).alias("_from"))
    return stream.join(begin, experiment).filter(F.col(time_col) >= F.col("_from")).drop("_from")


def cumulative_moments(stream: DataFrame, value: str, is_treatment, experiment: str,
                       nulls: str = "error", **options) -> DataFrame:
    """Running state of each arm of each experiment, for ``run_running`` and ``cumulative_test``."""
    if nulls == "drop":
        stream = stream.filter(is_treatment.isNotNull())
    arm = not_null(is_treatment, "the group")
    return running_state(stream.withColumn("treatment", arm), [value], [experiment, "treatment"],
                         nulls=nulls, **options)


def cumulative_test(spark, out_path: str, experiment: str, method: str = WELCH,
                    upto: int | None = None) -> DataFrame:
    """One test row per experiment over all its rows so far: (experiment, n_a, n_b, p_value,
    degrees_of_freedom, statistic, method, null_hypothesis); control is a, treatment b."""
    if method not in METHOD_NAMES:
        raise ValueError(f"unknown test method {method!r}; use one of {list(METHOD_NAMES)}")
    ship(spark)
    s = running_states(spark, out_path, [experiment, "treatment"], upto)
    var = F.when(F.col("n") > 1, F.col("m2") / (F.col("n") - 1))
    picked = []
    for side, arm in (("a", False), ("b", True)):
        mine = F.col("treatment") == F.lit(arm)
        picked += [F.coalesce(F.max(F.when(mine, F.col("n"))), F.lit(0)).alias(f"n_{side}"),
                   F.max(F.when(mine, F.col("mean"))).alias(f"mean_{side}"),
                   F.max(F.when(mine, var)).alias(f"var_{side}")]
    moments = s.groupBy(quoted(experiment)).agg(*picked)
    return moments.select(quoted(experiment), "n_a", "n_b", *test_columns(method))
