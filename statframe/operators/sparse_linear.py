"""Least-squares regression by gradient descent on sparse rows of any width.

Weights are a table ``(feature, weight)``: nothing as wide as the model is ever on the driver
or in a task's closure.  The cells are laid out once, as two bucketed tables: by feature for the
margin w.x and by row for the gradient.  Each iteration

* joins the cells by feature with the weights and sums the products per row: the margin,
* subtracts the label: the residual, one number per row, written to the shared folder,
* joins the cells by row with the residuals and sums residual * value per feature: the gradient,
* writes the weights of the next step.

Neither join moves cells; what is shuffled are weights, residuals and partial sums.  A feature with
more than ``split`` cells is dealt to several buckets, and its weight is copied to each of them.  The
driver gets a few sums per iteration.  Steps, stopping rule and start are those of ``linear.train_sgd``:
step / sqrt(i), stop when ||w_i - w_{i-1}|| < tol * max(||w_i||, 1) from the second step on, zero
weights, an intercept of 1.0 to start with.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from statframe.functions.columns import not_null
from statframe.operators.linear import CONVERGENCE_TOL
from statframe.session import scratch_path

SPLIT = 1 << 20  # cells of one feature that share a bucket


@dataclass
class SparseLinearModel:
    """``weights (feature, weight)`` of the features that have one; others weigh 0."""

    weights: DataFrame
    intercept: float = 0.0
    iterations: int = 0
    loss_history: list[float] = field(default_factory=list)

    def predict(self, cells: DataFrame, rows: DataFrame, row: str = "row_id",
                feature: str = "feature", value: str = "value") -> DataFrame:
        """(row, prediction) for every row of ``rows``; a row without cells gets the intercept."""
        x = cells.select(F.col(f"`{row}`").alias("_r"), F.col(f"`{feature}`").alias("feature"),
                         F.col(f"`{value}`").cast("double").alias("_x"))
        margin = x.join(self.weights, "feature").groupBy("_r").agg(
            F.sum(F.col("_x") * F.col("weight")).alias("_m"))
        ids = rows.select(F.col(f"`{row}`").alias("_r"))
        return ids.join(margin, "_r", "left").select(
            F.col("_r").alias(row), (F.coalesce("_m", F.lit(0.0)) + F.lit(self.intercept)).alias("prediction"))


class _Tables:
    """Bucketed tables of one training run; they leave the catalog with it."""

    def __init__(self, spark):
        self.spark, self.names = spark, []
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def lay_out(self, df: DataFrame, *keys: str) -> DataFrame:
        name = f"statframe_{uuid.uuid4().hex}"
        df.repartition(self.buckets, *keys).write.bucketBy(self.buckets, *keys).option(
            "path", scratch_path(self.spark, "cells")).saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def drop(self):
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def _written(df: DataFrame, name: str, **sums) -> tuple[DataFrame, dict]:
    """``df`` stored in the shared folder, with sums taken while it was written."""
    spark, seen = df.sparkSession, Observation()
    path = scratch_path(spark, name)
    watched = df.observe(seen, *[c.alias(k) for k, c in sums.items()]) if sums else df
    watched.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get if sums else {}


def train_sgd_sparse(cells: DataFrame, rows: DataFrame, row: str = "row_id",
                     feature: str = "feature", value: str = "value", label: str = "label",
                     num_iterations: int = 100, step_size: float = 1.0, intercept: bool = False,
                     initial_weights: DataFrame | None = None,
                     convergence_tol: float = CONVERGENCE_TOL, split: int = SPLIT
                     ) -> SparseLinearModel:
    """Fit label ~ w.x (+ b) over ``rows (row, label)`` and ``cells (row, feature, value)``.

    Rows without cells are all zero and count; cells of other rows are left out.  A feature that a
    row lists twice adds up.  ``initial_weights`` is a table (feature, weight).  Nulls are errors.
    """
    spark = cells.sparkSession
    x = cells.select(not_null(F.col(f"`{row}`"), row).alias("_r"),
                     not_null(F.col(f"`{feature}`"), feature).alias("feature"),
                     not_null(F.col(f"`{value}`").cast("double"), value).alias("_x"))
    y = rows.select(not_null(F.col(f"`{row}`"), row).alias("_r"),
                    not_null(F.col(f"`{label}`").cast("double"), label).alias("_y"))
    tables = _Tables(spark)
    try:
        x = x.join(y.select("_r"), "_r", "left_semi")
        by_row = tables.lay_out(x, "_r")
        parts, _ = _written(by_row.groupBy("feature").agg(
            F.ceil(F.count(F.lit(1)) / F.lit(split)).alias("_parts")), "parts")
        by_feature = tables.lay_out(by_row.join(parts, "feature").select(
            "_r", "feature", F.pmod(F.xxhash64("_r"), "_parts").alias("_part"), "_x"),
            "feature", "_part")
        labels = tables.lay_out(y, "_r")
        spread = parts.select("feature", F.explode(F.sequence(
            F.lit(0).cast("long"), F.col("_parts") - 1)).alias("_part"))
        kind = by_row.schema["feature"].dataType.simpleString()
        w = spark.createDataFrame([], f"feature {kind}, weight double")
        if initial_weights is not None:
            w, _ = _written(initial_weights.select("feature", F.col("weight").cast("double")), "weights")
        b, losses, done, had = (1.0 if intercept else 0.0), [], 0, False
        for i in range(1, num_iterations + 1):
            margin = by_feature.join(spread.join(w, "feature"), ["feature", "_part"]).groupBy("_r").agg(
                F.sum(F.col("_x") * F.col("weight")).alias("_m"))
            e = F.coalesce(F.col("_m"), F.lit(0.0)) + F.lit(b) - F.col("_y")
            residual, s = _written(labels.join(margin, "_r", "left").select("_r", e.alias("_e")),
                                   "residuals", n=F.count(F.lit(1)), sum=F.sum("_e"),
                                   square=F.sum(F.col("_e") * F.col("_e")))
            if not s["n"]:
                raise ValueError("training needs at least one row")
            losses.append(s["square"] / (2 * s["n"]))
            step = step_size / math.sqrt(i)
            gradient = by_row.join(residual, "_r").groupBy("feature").agg(
                (F.sum(F.col("_e") * F.col("_x")) / F.lit(float(s["n"]))).alias("_g"))
            new = F.coalesce(F.col("weight"), F.lit(0.0)) - F.lit(step) * F.coalesce(
                F.col("_g"), F.lit(0.0))
            moved = w.join(gradient, "feature", "full").select(
                "feature", F.coalesce(F.col("weight"), F.lit(0.0)).alias("_old"), new.alias("weight"))
            change = F.col("weight") - F.col("_old")
            w, t = _written(moved, "weights", change=F.sum(change * change),
                            norm=F.sum(F.col("weight") * F.col("weight")))
            w = w.select("feature", "weight")
            b_old, b = b, (b - step * s["sum"] / s["n"] if intercept else b)
            done = i
            moved_by = math.sqrt((t["change"] or 0.0) + (b - b_old) ** 2)
            norm = math.sqrt((t["norm"] or 0.0) + (b * b if intercept else 0.0))
            if had and moved_by < convergence_tol * max(norm, 1.0):
                break
            had = True
    finally:
        tables.drop()
    return SparseLinearModel(w, b, done, losses)
