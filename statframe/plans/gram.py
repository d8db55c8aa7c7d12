"""Cross-product aggregates.

``comoments`` gives n, the column means and the centred co-moment matrix
C[i][j] = sum (x_i - m_i)(x_j - m_j).  ``cross_sums`` gives the uncentred
sums sum x_i x_j.  Narrow inputs (d <= UNROLL_MAX) compile to one unrolled
aggregate (built-in ``covar_pop`` / ``sum``).  Wider inputs would break
codegen's method size limit, so each task folds its Arrow batches into one
d x d numpy block (``mapInPandas``), emitted as (i, j, value) rows, and the
blocks are merged by a grouped sum — one shuffle of d^2 rows per task,
independent of the row count (plans/tiles.py is the form for very wide rows).  Centred blocks are merged with Chan's rule
C = sum C_p + sum n_p (m_p - m)(m_p - m)^T.
"""

from __future__ import annotations

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statframe.session import freeze
from statframe.ship import ship

UNROLL_MAX = 8


def _long_from_wide(wide: DataFrame, d: int, prefix: str, symmetric: bool = True) -> DataFrame:
    structs = []
    for i in range(d):
        for j in range(d):
            a, b = (i, j) if (i <= j or not symmetric) else (j, i)
            structs.append(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"),
                                    F.col(f"{prefix}_{a}_{b}").alias("value")))
    return wide.select("n", *[c for c in wide.columns if c.startswith("mean_")],
                       F.inline(F.array(*structs)))


def _in_order(x: Column) -> Column:
    """The sum of the tasks' values, added in the order of the tasks with the rounding errors carried
    along (Neumaier), so that it does not depend on which task comes first."""
    def add(a, v):
        total = a.s + v.x
        lost = F.when(F.abs(a.s) >= F.abs(v.x), (a.s - total) + v.x).otherwise((v.x - total) + a.s)
        return F.struct(total.alias("s"), (a.c + lost).alias("c"))

    start = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("c"))
    # one value per task
    ordered = F.array_sort(F.collect_list(F.struct(F.col("task"), x.alias("x"))))
    return F.aggregate(ordered, start, add, lambda a: a.s + a.c)


def comoments(data: DataFrame, exprs: list[Column]) -> DataFrame:
    """Long (n, mean_0..mean_{d-1}, i, j, value) with value = C[i][j]."""
    d = len(exprs)
    x = data.select(*[e.alias(f"_x{i}") for i, e in enumerate(exprs)])
    if d <= UNROLL_MAX:
        aggs = [F.count(F.lit(1)).alias("n")]
        aggs += [F.avg(f"_x{i}").alias(f"mean_{i}") for i in range(d)]
        for i in range(d):
            for j in range(i, d):
                aggs.append((F.covar_pop(f"_x{i}", f"_x{j}") * F.count(F.lit(1)))
                            .alias(f"c_{i}_{j}"))
        return _long_from_wide(x.agg(*aggs), d, "c")
    return _blocked_comoments(x, d)


def _blocked_comoments(x: DataFrame, d: int) -> DataFrame:
    import numpy as np
    import pandas as pd

    cols = [f"_x{i}" for i in range(d)]

    def block(batches):
        n, mean, c = 0, np.zeros(d), np.zeros((d, d))
        for pdf in batches:
            a = pdf[cols].to_numpy(dtype=np.float64)
            if len(a) == 0:
                continue
            nb = len(a)
            mb = a.mean(axis=0)
            z = a - mb
            cb = z.T @ z
            tot = n + nb
            delta = mb - mean
            c = c + cb + np.outer(delta, delta) * (n * nb / tot)
            mean = mean + delta * (nb / tot)
            n = tot
        if n == 0:
            return
        ii, jj = np.meshgrid(np.arange(d), np.arange(d), indexing="ij")
        yield pd.DataFrame({"task": np.full(d * d, TaskContext.get().partitionId(), np.int32),
                            "n": np.full(d * d, n, dtype=np.int64),
                            "i": ii.ravel().astype(np.int32), "j": jj.ravel().astype(np.int32),
                            "mi": mean[ii.ravel()], "mj": mean[jj.ravel()],
                            "value": c.ravel()})

    ship(x.sparkSession)
    # read by the means and by the merge: kept, so that the data is scanned once
    parts = freeze(x.mapInPandas(
        block, "task int, n long, i int, j int, mi double, mj double, value double"))
    # merged means per column, from the diagonal rows of each block
    diag = parts.filter(F.col("i") == F.col("j"))
    means = diag.groupBy("i").agg(
        F.sum("n").alias("n"), (_in_order(F.col("n") * F.col("mi")) / F.sum("n")).alias("m"))
    mi = means.select(F.col("i"), F.col("m").alias("gi"), "n")
    mj = means.select(F.col("i").alias("j"), F.col("m").alias("gj"))
    merged = (parts.join(F.broadcast(mi.drop("n")), "i").join(F.broadcast(mj), "j")
              .groupBy("i", "j")
              .agg(_in_order(F.col("value") + F.col("n") * (F.col("mi") - F.col("gi"))
                             * (F.col("mj") - F.col("gj"))).alias("value")))
    # d means and n, one row: bounded by the width
    mrows = means.orderBy("i").collect()
    if not mrows:
        raise ValueError("co-moments need at least one row")
    return merged.select(F.lit(mrows[0]["n"]).cast("long").alias("n"),
                         *[F.lit(r["m"]).alias(f"mean_{r['i']}") for r in mrows],
                         "i", "j", "value")


def cross_sums(data: DataFrame, exprs: list[Column]) -> DataFrame:
    """Long (i, j, value) with value = sum x_i x_j (uncentred).  Pass a
    column of ones among ``exprs`` to get n and the plain sums as well."""
    d = len(exprs)
    x = data.select(*[e.alias(f"_x{i}") for i, e in enumerate(exprs)])
    if d <= UNROLL_MAX:
        aggs = []
        for i in range(d):
            for j in range(i, d):
                aggs.append(F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"s_{i}_{j}"))
        wide = x.agg(*aggs)
        structs = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"),
                            F.col(f"s_{min(i, j)}_{max(i, j)}").alias("value"))
                   for i in range(d) for j in range(d)]
        return wide.select(F.inline(F.array(*structs)))

    import numpy as np
    import pandas as pd

    cols = [f"_x{i}" for i in range(d)]

    def block(batches):
        seen, s = False, np.zeros((d, d))
        for pdf in batches:
            a = pdf[cols].to_numpy(dtype=np.float64)
            seen = seen or len(a) > 0
            s += a.T @ a
        if not seen:
            return
        ii, jj = np.meshgrid(np.arange(d), np.arange(d), indexing="ij")
        yield pd.DataFrame({"i": ii.ravel().astype(np.int32), "j": jj.ravel().astype(np.int32),
                            "value": s.ravel()})

    ship(x.sparkSession)
    parts = x.mapInPandas(block, "i int, j int, value double")
    return parts.groupBy("i", "j").agg(F.sum("value").alias("value"))
