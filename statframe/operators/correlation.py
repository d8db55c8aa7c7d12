"""Covariance and correlation.

Output is long: ``(i int, j int, col_i string, col_j string, <value> double)``,
all d x d entries.  Pearson = covariance normalised by the diagonal; Spearman
= Pearson over average ranks (operators/rank.py).  Everything is one
aggregate over the data (plans/gram.py) plus arithmetic on a d x d table.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statframe.functions.columns import apply_null_policy, check, features, not_null, width
from statframe.operators import rank as rank_mod
from statframe.operators.rank import attach_ranks, column_sizes, ranked_counts, ranks_from_counts
from statframe.session import freeze
from statframe.plans.gram import comoments
from statframe.plans.tiles import SLICES, TILE, tiled_comoments

log = logging.getLogger("statframe")

NEAR_ZERO = 1e-12  # a variance at or below this is treated as exactly zero



def _label(long: DataFrame, names: list[str]) -> DataFrame:
    """Attach col_i / col_j names to an (i, j, ...) table."""
    name_of = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("i") + 1)
    name_of_j = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("j") + 1)
    return long.withColumn("col_i", name_of).withColumn("col_j", name_of_j)


def cov_matrix(df: DataFrame, cols, nulls: str = "error", dim: int | None = None) -> DataFrame:
    """Sample covariance (n - 1 divisor); needs at least two rows."""
    feats = features(df, cols, dim)
    raw = [cols] if isinstance(cols, str) else list(cols)
    df = apply_null_policy(df, raw, nulls)
    names = [n for n, _ in feats]
    cm = comoments(df, [not_null(e, n) for n, e in feats])
    n = F.col("n")
    cov = check(n > 1, F.col("value") / (n - 1).cast("double"),
                "covariance needs more than one row")
    return _label(cm.select("i", "j", cov.alias("cov")), names).select(
        "i", "j", "col_i", "col_j", "cov")


def cov_matrix_tiled(df: DataFrame, cols, nulls: str = "error", dim: int | None = None,
                     tile: int = TILE, slices: int = SLICES) -> DataFrame:
    """``cov_matrix`` of very wide rows, tile by tile (plans/tiles.py).  ``cols``: one array column, or
    columns."""
    raw = [cols] if isinstance(cols, str) else list(cols)
    df = apply_null_policy(df, raw, nulls)
    if isinstance(cols, str):
        d = width(df, cols, dim)
        names = [f"{cols}[{i}]" for i in range(d)]
        x = df.select(not_null(F.col(cols).cast("array<double>"), cols).alias("x"))
    else:
        feats = features(df, cols, dim)
        d, names = len(feats), [n for n, _ in feats]
        x = df.select(F.array(*[not_null(e, n) for n, e in feats]).alias("x"))
    n, _, long = tiled_comoments(x, d, tile, slices)
    if n < 2:
        raise ValueError("covariance needs more than one row")
    return _label(long.select("i", "j", (F.col("value") / F.lit(float(n - 1))).alias("cov")),
                  names).select("i", "j", "col_i", "col_j", "cov")


def corr_from_cov(cov: DataFrame, value: str = "cov") -> DataFrame:
    """Correlation from a long covariance table.

    sigma = sqrt(var), or 0 when |var| <= 1e-12; an entry whose sigma is 0 on
    either side is NaN; the diagonal is always 1.0.  The diagonal is joined
    on both indexes — a table of d rows, broadcast.
    """
    diag = cov.filter(F.col("i") == F.col("j")).select(
        F.col("i").alias("_k"),
        F.when(F.abs(F.col(value)) <= NEAR_ZERO, F.lit(0.0))
        .otherwise(F.sqrt(F.col(value))).alias("_s"))
    di = F.broadcast(diag.select(F.col("_k").alias("i"), F.col("_s").alias("_si")))
    dj = F.broadcast(diag.select(F.col("_k").alias("j"), F.col("_s").alias("_sj")))
    joined = cov.join(di, "i").join(dj, "j")
    si, sj = F.col("_si"), F.col("_sj")
    r = (F.when(F.col("i") == F.col("j"), F.lit(1.0))
         .when((si == 0) | (sj == 0), F.lit(float("nan")))
         .otherwise(F.col(value) / (si * sj)))
    return joined.select("i", "j", "col_i", "col_j", r.alias("corr"))


def pearson(df: DataFrame, cols, nulls: str = "error", dim: int | None = None) -> DataFrame:
    return corr_from_cov(cov_matrix(df, cols, nulls, dim))


LONG_FORM_MIN = 3  # columns above the broadcast bound from which one long join wins
TIED_ROWS = 1 << 16      # rows of one value that a shuffle may bring together, or
TIED_VALUES = 2000       # this share of all rows, where that is more: a column has fewer values above
ROWS_PER_TASK = 1 << 20  # rows that a task regroups


def spearman(df: DataFrame, cols, nulls: str = "error", dim: int | None = None,
             row_key: str | None = None, long_form: bool | None = None) -> DataFrame:
    """Pearson correlation of the columns' average ranks.

    Ranks are joined back per column while at most two columns exceed the
    broadcast bound (broadcast joins move no rows).  With more, every such
    column would cost a shuffle join of the full rows, so the cells go long
    instead: (row, column, value) joined once with all rank tables on
    (column, value) and regrouped per row — two shuffles whatever the width.  Values that own many rows
    are joined by broadcast, so that no task's share depends on the ties.
    That needs a row identity: ``row_key`` (a unique column) or a generated
    id, checkpointed so a recomputation cannot renumber rows.  ``long_form``
    forces either plan (None: choose by the checked sizes).
    """
    feats = features(df, cols, dim)
    raw = [cols] if isinstance(cols, str) else list(cols)
    df = apply_null_policy(df, raw, nulls)
    names = [n for n, _ in feats]
    keys = [f"_s{i}" for i in range(len(names))]
    extra = [F.col(row_key).alias("_rid")] if row_key else []
    base = df.select(*extra, *[e.alias(k) for k, (_, e) in zip(keys, feats)])
    tagged = ranked_counts(base, keys, nulls)
    sizes = column_sizes(tagged)
    ranks = ranks_from_counts(tagged)
    big = [k for k in keys if sizes.get(k, (0, 0))[0] > rank_mod.BROADCAST_ROWS]
    if long_form or (long_form is None and len(big) >= LONG_FORM_MIN):
        if not row_key:
            base = freeze(base.withColumn("_rid", F.monotonically_increasing_id()))
        cells = base.select("_rid", F.inline(F.array(*[
            F.struct(F.lit(k).alias("column"), F.col(k).alias("value")) for k in keys])))
        # a value that owns many rows would be one task's join: few values can, and those ranks are sent
        # to the cells; all others meet theirs by a shuffle
        rows = max((n for _, n in sizes.values()), default=0)
        many = F.col("n") > max(TIED_ROWS, rows // TIED_VALUES)
        key = ["column", "value"]
        often = F.broadcast(ranks.filter(many).select(*key, "avg_rank"))
        joined = cells.join(often, key).unionByName(cells.join(
            F.broadcast(ranks.filter(many).select(*key)), key, "left_anti").join(
            ranks.filter(~many).select(*key, "avg_rank"), key))
        # dealt before they are grouped: hardly any two cells of a row are in one task until then
        parts = -(-rows // ROWS_PER_TASK)
        if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
            joined = joined.repartition(parts, "_rid")
        else:
            joined = joined.repartition("_rid")
        # a row has one cell per column; more means that two rows share a row_key
        one = F.col("_cells") == len(keys)
        ranked = joined.groupBy("_rid").agg(F.count("*").alias("_cells"), *[
            F.max(F.when(F.col("column") == k, F.col("avg_rank"))).alias(f"{k}_rank")
            for k in keys]).select(*[
                check(one, F.col(f"{k}_rank"), "row_key does not identify rows uniquely").alias(
                    f"{k}_rank") for k in keys])
    else:
        ranked = attach_ranks(base, keys, ranks, sizes=sizes)
    cm = comoments(ranked, [F.col(f"{k}_rank") for k in keys])
    n = F.col("n")
    cov = check(n > 1, F.col("value") / (n - 1).cast("double"),
                "correlation needs more than one row")
    long = _label(cm.select("i", "j", cov.alias("cov")), names)
    return corr_from_cov(long)


#: correlation methods by name; add a function of (df, cols, nulls, dim) to offer another
METHODS: dict[str, Callable[..., DataFrame]] = {"pearson": pearson, "spearman": spearman}


def corr(df: DataFrame, cols, method: str = "pearson", nulls: str = "error",
         dim: int | None = None) -> DataFrame:
    """Correlation matrix by method name (C2, C9): exact names of ``METHODS``."""
    if method not in METHODS:
        raise ValueError(f"unrecognized correlation method {method!r}; "
                         f"supported: {', '.join(METHODS)}")
    return METHODS[method](df, cols, nulls=nulls, dim=dim)


def corr_pair(df: DataFrame, x: str, y: str, method: str = "pearson",
              nulls: str = "error") -> DataFrame:
    """Correlation of two columns of the same rows: one row (entry (0, 1))."""
    return corr(df, [x, y], method, nulls).filter((F.col("i") == 0) & (F.col("j") == 1))


def to_matrix(long: DataFrame, value: str = "corr"):
    """Collect a long d x d result as a numpy matrix (d^2 values, bounded by
    the width) with its column names, for display or driver-side algebra."""
    import numpy as np

    rows = long.select("i", "j", "col_i", value).collect()
    d = 1 + max(max(r["i"], r["j"]) for r in rows)
    m = np.full((d, d), np.nan)
    names = [""] * d
    for r in rows:
        m[r["i"], r["j"]] = r[value]
        names[r["i"]] = r["col_i"]
    if np.isnan(m).any():
        log.warning("the correlation matrix has NaN entries: a column without variance")
    return m, names


def corr_paired(x: DataFrame, y: DataFrame, key: str, x_col: str, y_col: str,
                method: str = "pearson", nulls: str = "error") -> DataFrame:
    """Correlation of two samples held in different DataFrames, paired by a
    caller key (the DataFrame form of zipping two sample collections):
    an equi-join on ``key`` (AQE broadcasts a small side, splits skew),
    then the same-row pair correlation."""
    left = x.select(F.col(key), F.col(x_col).alias("_x"))
    right = y.select(F.col(key), F.col(y_col).alias("_y"))
    out = corr_pair(left.join(right, key), "_x", "_y", method, nulls)
    return out.withColumn("col_i", F.lit(x_col)).withColumn("col_j", F.lit(y_col))
