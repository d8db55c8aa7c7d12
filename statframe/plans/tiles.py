"""Co-moments of very wide rows, tile by tile.

The d x d result is cut into tiles of ``tile`` columns a side.  Each batch of rows is centred on the
column means and cut into column strips; a strip goes to the tiles that it is a side of.
Tasks read the strips of a tile in order, multiply the two of a batch and add up, so that a task
holds two strips and one tile, whatever d.  What is shuffled is every strip once per tile of its
row and column of tiles, i.e. d / tile times the data, and d^2 sums per slice: neither depends
on the number of tasks.  Against one d x d block per task (plans/gram.py), this pays where d^2 times the
tasks exceeds d / tile times the rows' bytes, and where a d x d block does not fit into a task.

Sums are added in the order of the batches, slices in order, so a rerun over the same files gives
the same bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statframe.session import freeze
from statframe.ship import ship

TILE = 256
SLICES = 8  # parts of the rows that are summed on their own, for more tasks than tiles


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    flat = batch.column("x").flatten()
    if flat.null_count:
        raise ValueError("null value in a feature array")
    if len(flat) != batch.num_rows * d or any(
            n != d for n in np.diff(np.asarray(batch.column("x").offsets))):
        raise ValueError(f"dimensions mismatch: expecting {d} values")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, d)


def column_means(x: DataFrame, d: int) -> tuple[int, np.ndarray]:
    """Rows and column means of an array column ``x``: d numbers for the driver."""
    def sums(batches):
        n, s = 0, np.zeros(d)
        for b in batches:
            if b.num_rows:
                n, s = n + b.num_rows, s + _matrix(b, d).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d, TaskContext.get().partitionId()), pa.int32()),
                 pa.array(np.arange(d), pa.int32()), pa.array(np.full(d, n), pa.int64()), pa.array(s)],
                names=["task", "i", "n", "s"])

    parts = x.mapInArrow(sums, "task int, i int, n long, s double")
    total = F.aggregate(F.array_sort(F.collect_list(F.struct("task", "s"))), F.lit(0.0),
                        lambda a, v: a + v.s)
    rows = parts.groupBy("i").agg(F.sum("n").alias("n"), total.alias("s")).collect()
    if not rows:
        raise ValueError("co-moments need at least one row")
    mean = np.zeros(d)
    for r in rows:
        mean[r["i"]] = r["s"] / r["n"]
    return rows[0]["n"], mean


def tiled_comoments(x: DataFrame, d: int, tile: int = TILE, slices: int = SLICES
                    ) -> tuple[int, np.ndarray, DataFrame]:
    """n, the means and the table (i, j, value) of sum (x_i - m_i)(x_j - m_j), all d x d entries,
    for the array column ``x`` of width d."""
    if tile < 1 or slices < 1:
        raise ValueError("tile and slices must be positive")
    ship(x.sparkSession)
    n, mean = column_means(x, d)
    tiles = -(-d // tile)

    def strips(batches):
        task, seen = TaskContext.get().partitionId(), 0
        for b in batches:
            if not b.num_rows:
                continue
            a = _matrix(b, d) - mean
            cut = [np.ascontiguousarray(a[:, t * tile:(t + 1) * tile]).tobytes() for t in range(tiles)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(tiles, task << 32 | seen), pa.int64()),
                 pa.array(np.arange(tiles), pa.int32()), pa.array(cut, pa.binary())],
                names=["batch", "t", "strip"])
            seen += 1

    cut = x.mapInArrow(strips, "batch long, t int, strip binary")
    dealt = cut.withColumn("u", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))).select(
        F.least("t", "u").alias("ti"), F.greatest("t", "u").alias("tj"),
        F.pmod(F.xxhash64("batch"), F.lit(slices)).alias("slice"), "batch",
        (F.col("t") > F.col("u")).alias("right"), "strip")
    keys = ["ti", "tj", "slice"]
    parts = int(x.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(parts, *keys).sortWithinPartitions(*keys, "batch", "right")

    def multiply(batches):
        key, total, left = None, None, None

        def done():
            i0, j0 = key[0] * tile, key[1] * tile
            h, w = total.shape
            ii, jj = np.divmod(np.arange(h * w), w)
            return pa.RecordBatch.from_arrays(
                [pa.array((ii + i0).astype(np.int32)), pa.array((jj + j0).astype(np.int32)),
                 pa.array(np.full(h * w, key[2], np.int64)), pa.array(total.reshape(-1))],
                names=["i", "j", "slice", "value"])

        for b in batches:
            for r in range(b.num_rows):
                ti, tj, s, _, right, data = (c[r].as_py() for c in b.columns)
                if (ti, tj, s) != key:
                    if key is not None:
                        yield done()
                    key = ti, tj, s
                    shape = [min(tile, d - t * tile) for t in (ti, tj)]
                    total = np.zeros(shape)
                a = np.frombuffer(data).reshape(-1, shape[1] if right else shape[0])
                if ti == tj:
                    total += a.T @ a
                elif right:
                    total += left.T @ a
                else:
                    left = a
        if key is not None:
            yield done()

    sums = dealt.mapInArrow(multiply, "i int, j int, slice long, value double")
    value = F.aggregate(F.array_sort(F.collect_list(F.struct("slice", "value"))), F.lit(0.0),
                        lambda a, v: a + v.value)
    half = freeze(sums.groupBy("i", "j").agg(value.alias("value")))
    # tiles below the diagonal mirror those above
    mirror = half.filter(F.floor(F.col("i") / tile) < F.floor(F.col("j") / tile)).select(
        F.col("j").alias("i"), F.col("i").alias("j"), "value")
    return n, mean, half.unionByName(mirror)
