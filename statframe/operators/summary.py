"""Column summaries (S1-S12): count, mean, variance, nonzeros, max, min, L1, L2.

The work is split into a *mergeable state* per (group, column) and a
*finalizer*.  ``col_summary`` is ``finalize(summary_state(...))``; states of
several slices (days, files, stream windows) roll up with ``merge_states`` and
finalize to the same numbers as a direct summary.

State columns (one row per group and input column)::

    column, n, w_sum, w2_sum, mean, m2, nnz, n_zero, max_nz, min_nz, norm_l1, l2_sq

``m2`` is the weighted sum of squared deviations from ``mean`` over all rows,
zeros included; ``max_nz`` / ``min_nz`` range over nonzero, non-NaN values only
and the zero rule is applied at finalization, as in the reference.

Every aggregate is a built-in (partial + final hash aggregation, one shuffle
of at most ``groups x columns`` partial rows per task); the unweighted path is
a single scan, weighted or not.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statframe.functions.columns import apply_null_policy, check, features, join_keys, named, not_null, quoted
from statframe.session import freeze
from statframe.ship import ship

DOUBLE_MAX = 1.7976931348623157e308  # the largest finite double; max/min start values

STATE_FIELDS = ("n", "w_sum", "w2_sum", "mean", "m2", "nnz", "n_zero",
                "max_nz", "min_nz", "norm_l1", "l2_sq")
SUMMARY_FIELDS = ("column", "count", "mean", "variance", "num_nonzeros", "max",
                  "min", "norm_l1", "norm_l2")


def _q(keys: Sequence[str]) -> list[Column]:
    """Group columns by their exact names."""
    return [quoted(k) for k in keys]


def _prepare(df: DataFrame, cols, weight: str | None, group_by: Sequence[str],
             nulls: str, dim: int | None):
    """Project keys, checked features ``_x{i}`` and weight ``_w``."""
    group_by = list(group_by)
    feats = features(df, cols, dim)
    raw = [c for c in ([cols] if isinstance(cols, str) else list(cols))]
    df = apply_null_policy(df, raw + ([weight] if weight else []), nulls)
    clash = sorted(set(group_by) & {"column", *SUMMARY_FIELDS, *STATE_FIELDS})
    if clash:
        raise ValueError(f"rename the group column {clash[0]!r}: the result has a column of this name")
    proj = [named(df, k).alias(k) for k in group_by]
    proj += [not_null(expr, name).alias(f"_x{i}") for i, (name, expr) in enumerate(feats)]
    if weight is not None:
        w = not_null(named(df, weight).cast("double"), weight)
        proj.append(check((w >= 0) & ~F.isnan(w), w, f"sample weight in {weight} has to be >= 0").alias("_w"))
    out = df.select(*proj)
    if weight is not None:
        out = out.filter(F.col("_w") > 0)  # weight 0 rows are skipped entirely
    return out, [name for name, _ in feats], group_by


def _common_aggs(i: int, wcol: Column | None) -> list[Column]:
    x = F.col(f"_x{i}")
    nz = (x != 0) & ~F.isnan(x)
    aggs = [
        (F.count_if(x != 0).cast("double") if wcol is None
         else F.sum(F.when(x != 0, wcol).otherwise(F.lit(0.0)))).alias(f"nnz_{i}"),
        F.count_if(x == 0).alias(f"n_zero_{i}"),
        F.max(F.when(nz, x)).alias(f"max_nz_{i}"),
        F.min(F.when(nz, x)).alias(f"min_nz_{i}"),
        F.sum(F.abs(x) if wcol is None else wcol * F.abs(x)).alias(f"norm_l1_{i}"),
        F.sum(x * x if wcol is None else wcol * x * x).alias(f"l2_sq_{i}"),
    ]
    return aggs


def _unpivot(wide: DataFrame, keys: list[str], names: list[str],
             shared: dict[str, str]) -> DataFrame:
    """Wide one-row-per-group state -> long state, one row per column."""
    structs = []
    for i, name in enumerate(names):
        fields = [F.lit(name).alias("column")]
        for f in STATE_FIELDS:
            src = shared.get(f, f"{f}_{i}")
            fields.append(F.col(src).alias(f))
        structs.append(F.struct(*fields))
    return wide.select(*_q(keys), F.inline(F.array(*structs)))


WIDE_MIN = 24  # from this many columns on, states are built per task with numpy


def summary_state(df: DataFrame, cols, weight: str | None = None,
                  group_by: Sequence[str] = (), nulls: str = "error",
                  dim: int | None = None) -> DataFrame:
    """Mergeable summary state per group and column (see module doc)."""
    data, names, keys = _prepare(df, cols, weight, group_by, nulls, dim)
    d = len(names)
    weighted = weight is not None
    if d >= WIDE_MIN and not keys:
        # task states are few (tasks x columns) and are read twice by the
        # merge: materialise them once in the shared checkpoint folder
        return merge_states(freeze(_task_states(data, names, weighted)), keys)
    if d >= WIDE_MIN:
        return merge_states(freeze(_group_states(data, names, keys, weighted)), keys)
    wide = _wide_state(data, d, keys, weighted)
    return _unpivot(wide, keys, names, {"n": "n", "w_sum": "w_sum", "w2_sum": "w2_sum"})


def _wide_state(data: DataFrame, d: int, keys: list[str], weighted: bool,
                around: list[Column] | None = None) -> DataFrame:
    """One row per group with n, w_sum, w2_sum and, per feature i, the
    fields ``<state>_i`` (unrolled built-in aggregates over ``_x{i}``)."""
    if not weighted:
        aggs = [F.count(F.lit(1)).alias("n")]
        for i in range(d):
            x = F.col(f"_x{i}")
            aggs += [F.avg(x).alias(f"mean_{i}"),
                     (F.var_pop(x) * F.count(x)).alias(f"m2_{i}")]
            aggs += _common_aggs(i, None)
        wide = data.groupBy(*_q(keys)).agg(*aggs)
        return wide.withColumn("w_sum", F.col("n").cast("double")).withColumn(
            "w2_sum", F.col("n").cast("double"))

    # one pass: the centred moment is taken around a reference point per column, where the
    # shift formula does not cancel for data that sit far from 0
    w = F.col("_w")
    around = [F.lit(r) for r in _references(data, d)] if around is None else around
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(w).alias("w_sum"),
            F.sum(w * w).alias("w2_sum")]
    for i in range(d):
        z = F.col(f"_x{i}") - around[i]
        aggs += [F.sum(w * z).alias(f"wz_{i}"), F.sum(w * z * z).alias(f"wzz_{i}"),
                 F.min(around[i]).alias(f"ref_{i}")]
        aggs += _common_aggs(i, w)
    sums = data.groupBy(*_q(keys)).agg(*aggs)
    shift = [F.try_divide(F.col(f"wz_{i}"), F.col("w_sum")) for i in range(d)]
    return sums.select(
        "*", *[(F.col(f"ref_{i}") + shift[i]).alias(f"mean_{i}") for i in range(d)],
        *[F.greatest(F.col(f"wzz_{i}") - F.col(f"wz_{i}") * shift[i], F.lit(0.0)).alias(f"m2_{i}")
          for i in range(d)])


def _references(data: DataFrame, d: int) -> list[float]:
    """The first row's values: d numbers, 0 where they are not finite."""
    row = data.limit(1).collect()
    values = [row[0][f"_x{i}"] if row else None for i in range(d)]
    return [float(v) if v is not None and math.isfinite(v) else 0.0 for v in values]


def _task_states(data: DataFrame, names: list[str], weighted: bool) -> DataFrame:
    """Per-task states for wide inputs (``mapInPandas``).

    Hundreds of unrolled aggregates exceed codegen's method size and run
    interpreted; instead each task folds its Arrow batches into one state
    row per column with numpy — Chan's rule merges batch moments —
    and ``merge_states`` combines the task states: one shuffle of
    tasks x columns rows.  An empty state per column stands for empty input.
    """
    import numpy as np
    import pandas as pd

    d = len(names)
    xcols = [f"_x{i}" for i in range(d)]
    schema = ("`column` string, n long, w_sum double, w2_sum double, mean double, m2 double, "
              "nnz double, n_zero long, max_nz double, min_nz double, norm_l1 double, "
              "l2_sq double")

    def fold(batches):
        a = None
        for pdf in batches:
            if not len(pdf):
                continue
            x = pdf[xcols].to_numpy(dtype=np.float64)
            w = pdf["_w"].to_numpy(dtype=np.float64) if weighted else np.ones(len(pdf))
            wb = w.sum()
            nz = (x != 0) & ~np.isnan(x)
            with np.errstate(invalid="ignore"):  # infinities make NaN moments, as in the sums
                mb = (w[:, None] * x).sum(axis=0) / wb
                part = dict(n=len(pdf), w=wb, w2=(w * w).sum(), mean=mb,
                            m2=(w[:, None] * (x - mb) ** 2).sum(axis=0),
                            nnz=(w[:, None] * (x != 0)).sum(axis=0), zero=(x == 0).sum(axis=0),
                            seen=nz.any(axis=0), mx=np.where(nz, x, -np.inf).max(axis=0),
                            mn=np.where(nz, x, np.inf).min(axis=0),
                            l1=(w[:, None] * np.abs(x)).sum(axis=0),
                            l2=(w[:, None] * x * x).sum(axis=0))
                if a is None:
                    a = part
                    continue
                tot = a["w"] + wb
                delta = mb - a["mean"]
                a["m2"] = a["m2"] + part["m2"] + delta * delta * a["w"] * wb / tot
                a["mean"] = a["mean"] + delta * wb / tot
            a["w"] = tot
            for f in ("n", "w2", "nnz", "zero", "l1", "l2"):
                a[f] = a[f] + part[f]
            a["seen"] = a["seen"] | part["seen"]
            a["mx"], a["mn"] = np.maximum(a["mx"], part["mx"]), np.minimum(a["mn"], part["mn"])
        if a is None:
            return

        def extreme(values):
            # no nonzero value seen: null, which Spark's max and min skip (an infinity is a value)
            return pd.Series(values, dtype="float64").astype("Float64").where(
                pd.Series(a["seen"]), pd.NA)

        yield pd.DataFrame({"column": names, "n": np.full(d, a["n"], dtype=np.int64),
                            "w_sum": np.full(d, a["w"]), "w2_sum": np.full(d, a["w2"]),
                            "mean": a["mean"], "m2": a["m2"], "nnz": a["nnz"],
                            "n_zero": a["zero"].astype(np.int64), "max_nz": extreme(a["mx"]),
                            "min_nz": extreme(a["mn"]), "norm_l1": a["l1"], "l2_sq": a["l2"]})

    ship(data.sparkSession)
    empty = data.sparkSession.createDataFrame(
        [(n, 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0, None, None, 0.0, 0.0) for n in names], schema)
    return data.mapInPandas(fold, schema).unionByName(empty)


MAX_CELLS = 1 << 20  # cells (groups x columns) that a task holds before it sends them on

_MOMENTS = ("n", "w", "w2")            # one number per group
_COLUMNS = ("mean", "m2", "nnz", "zero", "seen", "mx", "mn", "l1", "l2")  # one per group and column


class _GroupStates:
    """States of the groups that a task has met: arrays with one row per group."""

    def __init__(self, d: int):
        self.d, self.place, self.keys = d, {}, []
        self.part: dict = {}

    def add(self, keys: list[tuple], part: dict):
        """Merge one state per group into those held (Chan's rule)."""
        import numpy as np

        new = [k for k in keys if k not in self.place]
        for k in new:
            self.place[k] = len(self.keys)
            self.keys.append(k)
        at = np.array([self.place[k] for k in keys])
        if new:
            for f in (*_MOMENTS, *_COLUMNS):
                blank = np.zeros((len(new), *part[f].shape[1:]), part[f].dtype)
                if f in ("mx", "mn"):
                    blank += -np.inf if f == "mx" else np.inf
                self.part[f] = np.concatenate([self.part[f], blank]) if f in self.part else blank
        p = self.part
        w, wb = p["w"][at][:, None], part["w"][:, None]
        total = w + wb
        first = p["n"][at] == 0
        with np.errstate(invalid="ignore"):
            delta = np.where(first[:, None], 0.0, part["mean"] - p["mean"][at])
            p["m2"][at] = p["m2"][at] + part["m2"] + delta * delta * w * wb / total
            p["mean"][at] = np.where(first[:, None], part["mean"], p["mean"][at] + delta * wb / total)
        for f in ("n", "w", "w2", "nnz", "zero", "l1", "l2"):
            p[f][at] = p[f][at] + part[f]
        p["seen"][at] |= part["seen"]
        p["mx"][at] = np.maximum(p["mx"][at], part["mx"])
        p["mn"][at] = np.minimum(p["mn"][at], part["mn"])


def _plain(keys):
    """A key column that has a dictionary: nested ones as text."""
    import pyarrow as pa

    return pa.array([repr(v) for v in keys.to_pylist()]) if pa.types.is_nested(keys.type) else keys


def _batch_states(x, w, group, count):
    """The states of a batch's groups; ``group`` numbers them 0 .. count - 1."""
    import numpy as np

    order = np.argsort(group, kind="stable")
    x, w, starts = x[order], w[order][:, None], np.searchsorted(group[order], np.arange(count))

    def total(v):
        return np.add.reduceat(v, starts, axis=0)

    nz = (x != 0) & ~np.isnan(x)
    with np.errstate(invalid="ignore"):  # infinities make NaN moments, as in the sums
        wg = total(w)
        mean = total(w * x) / wg
        m2 = total(w * (x - np.repeat(mean, np.diff([*starts, len(x)]), axis=0)) ** 2)
        return dict(n=np.diff([*starts, len(x)]), w=wg[:, 0], w2=total(w * w)[:, 0], mean=mean, m2=m2,
                    nnz=total(w * (x != 0)), zero=total((x == 0).astype(np.int64)),
                    seen=np.maximum.reduceat(nz, starts, axis=0),
                    mx=np.maximum.reduceat(np.where(nz, x, -np.inf), starts, axis=0),
                    mn=np.minimum.reduceat(np.where(nz, x, np.inf), starts, axis=0),
                    l1=total(w * np.abs(x)), l2=total(w * x * x))


def _group_states(data: DataFrame, names: list[str], keys: list[str], weighted: bool) -> DataFrame:
    """Per-task states by group for wide inputs: every task folds its Arrow batches into one
    state per group and column, and sends them on at its end, or when it holds MAX_CELLS.  At most
    tasks x groups x columns rows are shuffled, however many rows there are."""
    import numpy as np
    import pyarrow as pa

    d = len(names)
    packed = data.select(F.struct(*_q(keys)).alias("key"), F.array(*[
        F.col(f"_x{i}") for i in range(d)]).alias("x"), (F.col("_w") if weighted else F.lit(1.0)).alias("w"))
    counts = ("n", "n_zero")
    schema = T.StructType([
        T.StructField("key", packed.schema["key"].dataType), T.StructField("column", T.StringType()),
        *[T.StructField(f, T.LongType() if f in counts else T.DoubleType()) for f in STATE_FIELDS]])

    def rows(held: _GroupStates, key_type):
        p, g = held.part, len(held.keys)
        at = np.repeat(np.arange(g), d)

        def flat(f):
            return pa.array(p[f].reshape(-1))

        def extreme(f):  # no nonzero value seen: null (an infinity is a value)
            return pa.array(p[f].reshape(-1), mask=~p["seen"].reshape(-1))

        key = pa.concat_arrays([k.cast(key_type) for k in held.values]).take(pa.array(at))
        return pa.RecordBatch.from_arrays(
            [key, pa.array(names * g, pa.string()), pa.array(p["n"][at], pa.int64()),
             pa.array(p["w"][at]), pa.array(p["w2"][at]), flat("mean"), flat("m2"), flat("nnz"),
             pa.array(p["zero"].reshape(-1), pa.int64()), extreme("mx"), extreme("mn"), flat("l1"),
             flat("l2")],
            names=["key", "column", *STATE_FIELDS])

    def fold(batches):
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            key = b.column("key")
            # groups of the batch: the keys' places in each column's dictionary, null as one
            codes = [_plain(c).dictionary_encode("encode").indices.to_numpy() for c in key.flatten()]
            _, first, group = np.unique(np.stack(codes, axis=1), axis=0, return_index=True,
                                        return_inverse=True)
            values = key.take(pa.array(first))
            part = _batch_states(b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d),
                                 b.column("w").to_numpy(), group.reshape(-1), len(first))
            if held is None:
                held = _GroupStates(d)
                held.values = []
            ids = [repr(v) for v in values.to_pylist()]  # repr tells null, NaN and text apart
            fresh = [i for i, k in enumerate(ids) if k not in held.place]
            held.values.append(values.take(pa.array(fresh, pa.int64())))
            held.add(ids, part)
            if len(held.keys) * d >= MAX_CELLS:
                yield rows(held, key.type)
                held = None
        if held is not None:
            yield rows(held, held.values[0].type)

    ship(data.sparkSession)
    states = packed.mapInArrow(fold, schema)
    return states.select("key.*", "column", *STATE_FIELDS)


def merge_states(state: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Roll states up to ``group_by`` (a subset of the state's keys).

    m2 = sum m2_i + sum W_i (mean_i - mean)^2 needs the merged mean, so the
    state rows are aggregated twice: once for weights and means, once more,
    joined on (keys, column), for the moment.  Both are partial/final hash
    aggregates, so a key owning a third of the state rows is still spread
    over all tasks until the final merge of one row per task.
    """
    keys = list(group_by) + ["column"]
    base = state.groupBy(*_q(keys)).agg(
        F.sum("n").alias("n"), F.sum("w_sum").alias("w_sum"),
        F.sum("w2_sum").alias("w2_sum"),
        F.try_divide(F.sum(F.col("w_sum") * F.col("mean")), F.sum("w_sum")).alias("mean"),
        F.sum("nnz").alias("nnz"), F.sum("n_zero").alias("n_zero"),
        F.max("max_nz").alias("max_nz"), F.min("min_nz").alias("min_nz"),
        F.sum("norm_l1").alias("norm_l1"), F.sum("l2_sq").alias("l2_sq"))
    moment = (join_keys(state, base.select(*_q(keys), F.col("mean").alias("_m")), keys)
              .groupBy(*_q(keys))
              .agg(F.sum(F.col("m2") + F.col("w_sum") * (F.col("mean") - F.col("_m"))
                         * (F.col("mean") - F.col("_m"))).alias("m2")))
    return join_keys(base, moment, keys).select(*_q(keys), *STATE_FIELDS)


def finalize(state: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """State rows -> summary rows, with the reference's special rules."""
    keys = list(group_by)
    n = F.col("n")
    w_sum, w2_sum = F.col("w_sum"), F.col("w2_sum")
    has_data = F.coalesce(w_sum, F.lit(0.0)) > 0
    denom = w_sum - w2_sum / w_sum
    max_nz = F.coalesce(F.col("max_nz"), F.lit(-DOUBLE_MAX))
    min_nz = F.coalesce(F.col("min_nz"), F.lit(DOUBLE_MAX))
    has_zero = F.col("n_zero") > 0

    def guarded(c: Column) -> Column:
        return check(has_data, c, "nothing has been added to this summary (empty input)")

    return state.select(
        *_q(keys),
        F.col("column"),
        F.col("n").cast("long").alias("count"),
        guarded(F.col("mean")).alias("mean"),
        guarded(F.when(denom > 0, F.col("m2") / denom).otherwise(F.lit(0.0))).alias("variance"),
        guarded(F.col("nnz")).alias("num_nonzeros"),
        guarded(F.when(has_zero, F.greatest(max_nz, F.lit(0.0))).otherwise(max_nz)).alias("max"),
        guarded(F.when(has_zero, F.least(min_nz, F.lit(0.0))).otherwise(min_nz)).alias("min"),
        guarded(F.col("norm_l1")).alias("norm_l1"),
        guarded(F.sqrt(F.col("l2_sq"))).alias("norm_l2"),
    )


def col_summary(df: DataFrame, cols, weight: str | None = None,
                group_by: Sequence[str] = (), nulls: str = "error",
                dim: int | None = None) -> DataFrame:
    """Summary of every feature column, one row per (group, column).

    ``cols``: list of numeric column names or the name of an array column.
    ``weight``: optional nonnegative weight column; rows of weight 0 are
    skipped, as in the reference, and ``count`` counts the remaining rows.
    """
    return finalize(summary_state(df, cols, weight, group_by, nulls, dim), group_by)


def sparse_summary(long: DataFrame, row_id: str = "row_id", idx: str = "idx",
                   value: str = "value", num_rows: DataFrame | int | None = None,
                   group_by: Sequence[str] = (), width: int | None = None) -> DataFrame:
    """Summary of sparse vectors given in long form ``(row_id, idx, value)``.

    With ``width`` every index 0 .. width-1 gets a row, stored or not, and an index outside
    is an error; without it only stored indexes do.

    Absent cells are zeros, so only stored cells are scanned (the O(nnz)
    update of the reference).  The row count comes from ``num_rows`` or from
    the distinct row ids; implied zeros are ``rows - stored cells``.
    """
    keys = list(group_by)
    x = not_null(F.col(value).cast("double"), value)
    cells = long.select(*_q(keys), F.col(row_id), F.col(idx).cast("int").alias("_idx"), x.alias("_x"))
    if num_rows is None:
        rows = cells.groupBy(*_q(keys)).agg(F.count_distinct(row_id).alias("_rows"))
    elif isinstance(num_rows, int):
        rows = None
    else:
        rows = num_rows
    if width is not None:
        inside = (F.col("_idx") >= 0) & (F.col("_idx") < width)
        cells = cells.withColumn("_idx", check(inside, F.col("_idx"),
                                               f"an index lies outside 0..{width - 1}"))
        # an index that no row stores: one cell that counts as not stored
        every = F.explode(F.sequence(F.lit(0), F.lit(width - 1))).alias("_idx")
        grid = (cells.select(*_q(keys)).distinct().select(*_q(keys), every) if keys else
                cells.sparkSession.range(1).select(every))
        cells = cells.withColumn("_is", F.lit(1)).unionByName(
            grid.withColumn("_is", F.lit(0)), allowMissingColumns=True)
    else:
        cells = cells.withColumn("_is", F.lit(1))
    nz = (F.col("_x") != 0) & ~F.isnan(F.col("_x"))
    stats = cells.groupBy(*_q(keys), "_idx").agg(
        F.sum("_is").alias("_stored"),
        F.coalesce(F.sum("_x"), F.lit(0.0)).alias("_s1"),
        F.count_if(F.col("_x") != 0).cast("double").alias("nnz"),
        F.count_if(F.col("_x") == 0).alias("_zero_stored"),
        F.max(F.when(nz, F.col("_x"))).alias("max_nz"),
        F.min(F.when(nz, F.col("_x"))).alias("min_nz"),
        F.coalesce(F.sum(F.abs("_x")), F.lit(0.0)).alias("norm_l1"),
        F.coalesce(F.sum(F.col("_x") * F.col("_x")), F.lit(0.0)).alias("l2_sq"),
        F.coalesce(F.avg("_x"), F.lit(0.0)).alias("_mean_stored"),
        F.coalesce(F.var_pop("_x") * F.count("_x"), F.lit(0.0)).alias("_m2_stored"))
    if rows is None:
        stats = stats.withColumn("_rows", F.lit(int(num_rows)).cast("long"))
    elif keys:
        stats = join_keys(stats, rows, keys)
    else:
        total = rows.collect()[0]["_rows"]  # one number
        stats = stats.withColumn("_rows", F.lit(total).cast("long"))
    r = F.col("_rows").cast("double")
    k = F.col("_stored").cast("double")
    mean = F.col("_s1") / r
    # stored cells have moment m2_s around their own mean; implied zeros add
    # (r - k) * mean^2 around the full mean, and the shift adds k*(ms - mean)^2
    m2 = (F.col("_m2_stored") + k * (F.col("_mean_stored") - mean) * (F.col("_mean_stored") - mean)
          + (r - k) * mean * mean)
    state = stats.select(
        *_q(keys),
        F.concat(F.lit("x["), F.col("_idx").cast("string"), F.lit("]")).alias("column"),
        F.col("_rows").cast("long").alias("n"), r.alias("w_sum"), r.alias("w2_sum"),
        mean.alias("mean"), m2.alias("m2"), F.col("nnz"),
        (F.col("_zero_stored") + F.col("_rows") - F.col("_stored")).alias("n_zero"),
        "max_nz", "min_nz", "norm_l1", "l2_sq")
    return finalize(state, keys)
