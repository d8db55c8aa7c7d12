"""Average ranks with ties (C7) by a distributed prefix sum.

A bare ``Window.orderBy`` would pull every row into one task.  Instead:

1. explode the cells to (column, value) and count them per distinct value —
   a partial/final aggregate, so a value owning a third of the rows is one
   row from here on;
2. range-partition the distinct values on (column, value) and tag each row
   with its partition id; the range bounds come from sampling, so the tagged
   table is checkpointed to the shared folder (a recomputation after an
   executor loss must see the same bounds);
3. running count inside each (partition, column) — bounded by the range
   partition's size — plus the count of all earlier partitions of that
   column, from a table of ``partitions x columns`` rows that is broadcast.

A tie group is one row, so ties never straddle partitions.  Ranks are 0-based:
rank = (values below) + (ties - 1) / 2.  NaN is rejected (the reference gives
each NaN its own rank; SQL ranking would tie them — both are unsafe).
"""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statframe.functions.columns import (apply_null_policy, check, features, not_null, quoted,
                                         refuse_names)
from statframe.session import freeze


def _cells(df: DataFrame, feats) -> DataFrame:
    structs = []
    for name, expr in feats:
        v = not_null(expr, name)
        v = check(~F.isnan(v), v, f"NaN in {name}: ranks of NaN are undefined")
        structs.append(F.struct(F.lit(name).alias("column"), v.alias("value")))
    return df.select(F.inline(F.array(*structs)))


def ranked_counts(df: DataFrame, cols, nulls: str = "error", dim: int | None = None,
                  partitions: int | None = None) -> DataFrame:
    """Distinct (column, value) with their count ``n``, range-partitioned and
    tagged with the partition id ``_pid``; checkpointed (steps 1-2)."""
    feats = features(df, cols, dim)
    raw = [cols] if isinstance(cols, str) else list(cols)
    df = apply_null_policy(df, raw, nulls)
    counts = _cells(df, feats).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    # Without an explicit count AQE may merge adjacent range partitions to the
    # data's size; merged partitions stay in range order, so ids stay ordered.
    ranged = (counts.repartitionByRange(partitions, "column", "value") if partitions
              else counts.repartitionByRange("column", "value"))
    return freeze(ranged.withColumn("_pid", F.spark_partition_id()))


def ranks_from_counts(tagged: DataFrame) -> DataFrame:
    """``(column, value, n, below, avg_rank, total)`` from ``ranked_counts``
    (step 3); ``total`` is the column's row count, from the small offsets table."""
    local = tagged.withColumn("_cum", F.sum("n").over(
        Window.partitionBy("_pid", "column").orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    offsets = (tagged.groupBy("column", "_pid").agg(F.sum("n").alias("_tot"))
               .withColumn("_off", F.coalesce(F.sum("_tot").over(
                   Window.partitionBy("column").orderBy("_pid")
                   .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .withColumn("total", F.sum("_tot").over(Window.partitionBy("column")))
               .select("column", "_pid", "_off", "total"))
    ranked = local.join(F.broadcast(offsets), ["column", "_pid"])
    below = F.col("_off") + F.col("_cum") - F.col("n")
    return ranked.select("column", "value", "n", below.alias("below"),
                         (below.cast("double") + (F.col("n") - 1) / F.lit(2.0)).alias("avg_rank"),
                         "total")


def column_sizes(tagged: DataFrame) -> dict[str, tuple[int, int]]:
    """{column: (distinct values, rows)} — one small aggregate of the checkpoint."""
    return {r["column"]: (r["d"], r["rows"]) for r in tagged.groupBy("column").agg(
        F.count(F.lit(1)).alias("d"), F.sum("n").alias("rows")).collect()}


def value_ranks(df: DataFrame, cols, nulls: str = "error", dim: int | None = None,
                partitions: int | None = None) -> DataFrame:
    """Distinct values with their tie count and rank:
    ``(column string, value double, n bigint, below bigint, avg_rank double)``."""
    return ranks_from_counts(ranked_counts(df, cols, nulls, dim, partitions))


BROADCAST_ROWS = 1_000_000  # distinct values of one column we ship to every task (~32 MB)


def attach_ranks(df: DataFrame, cols, ranks: DataFrame, suffix: str = "_rank",
                 dim: int | None = None, sizes: dict | None = None) -> DataFrame:
    """Add one ``<col><suffix>`` column per feature: the row's average rank.

    Each column's rank table is joined on the value.  Its row count is
    checked first (one small aggregate over the rank table): up to
    BROADCAST_ROWS it is broadcast and the rows never move; beyond that the
    join shuffles, and AQE splits a value that owns a large share of rows.
    """
    feats = features(df, cols, dim)
    new = [f"{name}{suffix}" for name, _ in feats]
    refuse_names(df, new)
    if sizes is None:
        sizes = {r["column"]: r["cnt"] for r in
                 ranks.groupBy("column").agg(F.count(F.lit(1)).alias("cnt")).collect()}
    # the row travels as one struct: its columns may have any names
    out = df.select(F.struct(*[quoted(c) for c in df.columns]).alias("row"),
                    *[expr.alias(f"key{i}") for i, (_, expr) in enumerate(feats)])
    for i, (name, _) in enumerate(feats):
        r = ranks.filter(F.col("column") == name).select(
            F.col("value").alias(f"key{i}"), F.col("avg_rank").alias(f"rank{i}"))
        size = sizes.get(name, 0)
        if (size[0] if isinstance(size, tuple) else size) <= BROADCAST_ROWS:
            r = F.broadcast(r)
        out = out.join(r, on=f"key{i}", how="inner").drop(f"key{i}")
    return out.select("row.*", *[F.col(f"rank{i}").alias(n) for i, n in enumerate(new)])


def avg_rank(df: DataFrame, cols, nulls: str = "error", dim: int | None = None) -> DataFrame:
    """``df`` with the 0-based average rank of each feature column appended."""
    raw = [cols] if isinstance(cols, str) else list(cols)
    df = apply_null_policy(df, raw, nulls)
    tagged = ranked_counts(df, cols, nulls, dim)
    return attach_ranks(df, cols, ranks_from_counts(tagged), dim=dim, sizes=column_sizes(tagged))
