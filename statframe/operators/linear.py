"""Least-squares linear regression by gradient descent.

Full-batch gradient descent on (1/2n) sum (w.x - y)^2 only ever needs the
gradient A w - b with A = X'X / n and b = X'y / n.  So the data is scanned
once for the sufficient statistics (plans/gram.py) and the iterations run on
a d x d matrix on the driver, with the usual rules: step s / sqrt(i), stop
when ||w_i - w_{i-1}|| < tol * max(||w_i||, 1) from the second iteration on.

* intercept: a bias feature of 1.0 appended last; the starting intercept is
  1.0 (the bias is appended to the starting weights too).
* feature scaling: features are divided by their sample standard deviation
  (no centring; 0 for a constant feature), which is algebra on A and b — no
  extra pass — and the fitted weights are divided back.
* mini-batches: rows are hashed into buckets and iteration i
  uses a deterministic subset of buckets (an integer permutation per
  iteration, ``sampled_buckets``).  One pass collects
  per-bucket statistics (buckets x d^2 numbers), so every iteration is again
  driver arithmetic and reruns give the same model.  (RDD Bernoulli sampling
  cannot be reproduced; this sampler is documented as ours.)

Prediction is a projection w.x + b: literal weights up to a few columns, a vectorised
product beyond.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statframe.functions.columns import apply_null_policy, features, not_null
from statframe.plans.gram import UNROLL_MAX, cross_sums
from statframe.ship import ship

SAMPLE_BUCKETS = 1024
CONVERGENCE_TOL = 1e-3


@dataclass
class LinearModel:
    weights: list[float]
    intercept: float
    feature_names: list[str]
    iterations: int = 0
    loss_history: list[float] = field(default_factory=list)

    @property
    def num_features(self) -> int:
        return len(self.weights)

    def describe(self) -> str:
        return (f"LinearRegressionModel: intercept = {self.intercept}, "
                f"numFeatures = {self.num_features}")

    def predict_col(self, cols: Sequence[str] | str | None = None,
                    link: Callable[[Column], Column] | None = None) -> Column:
        """w.x + b as an expression; ``cols`` may be one array column, ``link`` is applied to
        the margin.  Up to UNROLL_MAX named columns stay in generated code; more go through
        one vectorised product per Arrow batch."""
        cols = cols or self.feature_names
        b = float(self.intercept)
        if not isinstance(cols, str) and len(list(cols)) != self.num_features:
            raise ValueError(f"expected {self.num_features} feature columns, got {len(list(cols))}")
        if not isinstance(cols, str) and len(cols) <= UNROLL_MAX:
            out = F.lit(b)
            for w, c in zip(self.weights, cols):
                out = out + F.col(c).cast("double") * F.lit(float(w))
        else:
            x = F.col(cols) if isinstance(cols, str) else F.array(*[F.col(c) for c in cols])
            out = _dot_udf(self.weights)(x.cast("array<double>")) + F.lit(b)
        return link(out) if link else out

    def predict(self, df: DataFrame, cols: Sequence[str] | str | None = None,
                output: str = "prediction", link: Callable[[Column], Column] | None = None
                ) -> DataFrame:
        ship(df.sparkSession)
        return df.withColumn(output, self.predict_col(cols, link))

    def coefficients(self, spark) -> DataFrame:
        rows = [(n, float(w)) for n, w in zip(self.feature_names, self.weights)]
        rows.append(("intercept", float(self.intercept)))
        return spark.createDataFrame(rows, "term string, coefficient double")

    def to_json(self) -> str:
        return json.dumps({"weights": self.weights, "intercept": self.intercept,
                           "feature_names": self.feature_names})


def _dot_udf(weights: Sequence[float]):
    """x -> w.x over an array column; null where x is null or holds one."""
    w = np.array(weights, dtype=np.float64)

    @F.pandas_udf("double")
    def dot(x: pd.Series) -> pd.Series:
        known = [v is not None and len(v) == len(w) for v in x]
        if any(v is not None and len(v) != len(w) for v in x):
            raise ValueError(f"expected {len(w)} values in every feature array")
        out = np.full(len(x), np.nan)
        rows = [v for v, k in zip(x, known) if k]
        if rows:
            out[np.array(known)] = np.stack(rows).astype(np.float64) @ w
        return pd.Series(out).where(~np.isnan(out), None)

    return dot


def _sgd(A: np.ndarray, b: np.ndarray, yy: float, w0: np.ndarray, iterations: int,
         step: float, tol: float, batch: Callable[[int], tuple] | None = None):
    """Replay gradient descent on sufficient statistics.

    ``A``, ``b`` are sums (not means); ``batch(i)`` may return per-iteration
    (A, b, yy, n) for mini-batches.  Returns (w, iterations run, loss history).
    """
    w = w0.astype(np.float64).copy()
    prev = None
    losses = []
    done = 0
    n_full = None
    for i in range(1, iterations + 1):
        if batch is not None:
            Ai, bi, yyi, n = batch(i)
        else:
            Ai, bi, yyi, n = A, b, yy, n_full
        if not n:
            done = i
            continue
        grad = (Ai @ w - bi) / n
        losses.append(float((w @ Ai @ w - 2 * w @ bi + yyi) / (2 * n)))
        w = w - (step / math.sqrt(i)) * grad
        done = i
        if prev is not None:
            diff = float(np.linalg.norm(prev - w))
            if diff < tol * max(float(np.linalg.norm(w)), 1.0):
                break
        prev = w
    return w, done, losses


def train_sgd(df: DataFrame, label: str, cols: Sequence[str] | str, num_iterations: int = 100,
              step_size: float = 1.0, mini_batch_fraction: float = 1.0,
              initial_weights: Sequence[float] | None = None, intercept: bool = False,
              feature_scaling: bool = False,
              validators: Sequence[Callable[[DataFrame], bool]] = (), validate: bool = True,
              sample_key: Column | None = None, convergence_tol: float = CONVERGENCE_TOL,
              nulls: str = "error", dim: int | None = None, buckets: int = SAMPLE_BUCKETS,
              gradient: Callable[[Column, Column], Column] | None = None) -> LinearModel:
    """Fit y ~ w.x (+ b) by (mini-batch) gradient descent; defaults as the
    reference's linear regression: 100 iterations, step 1.0, full batch,
    no intercept, starting from zero weights.

    ``cols``: feature columns, or the name of one array column (width ``dim``, else probed).
    ``buckets``: the mini-batch sampler's resolution; a fraction below 1 / buckets is an error.
    Rows are sampled by ``sample_key``, by default a hash of the row's values, so equal rows
    are drawn together.  ``gradient`` replaces least squares by another loss: a function of
    (margin, y) giving the loss's derivative in the margin; each iteration is then one scan.
    """
    raw = [cols] if isinstance(cols, str) else list(cols)
    feats = features(df, cols, dim) if raw else []
    cols = [n for n, _ in feats]
    d = len(cols)
    if d == 0:
        raise ValueError("at least one feature column is required")
    if not 0 < mini_batch_fraction <= 1:
        raise ValueError("mini_batch_fraction must be in (0, 1]")
    if initial_weights is not None and len(initial_weights) != d:
        raise ValueError(f"initial weights must have {d} entries")
    if validate and not all(v(df) for v in validators):
        raise ValueError("input validation failed")
    df = apply_null_policy(df, [label, *raw], nulls)
    xs = [not_null(e, n) for n, e in feats]
    y = not_null(F.col(label).cast("double"), label)
    # statistics over [x_0 .. x_{d-1}, 1, y]: A = [:d+1, :d+1], b = [:d+1, d+1]
    exprs = [*xs, F.lit(1.0), y]
    k = d + 2
    scale = np.ones(d)
    S_full = None
    if feature_scaling:
        var_aggs = [F.var_samp(f"_e{j}").alias(f"v{j}") for j in range(d)]
        proj = df.select(*[e.alias(f"_e{j}") for j, e in enumerate(exprs)])
        if k <= UNROLL_MAX and mini_batch_fraction >= 1.0:
            # one pass: the standard deviations ride along with the cross sums
            row = proj.agg(*var_aggs, *[
                F.sum(F.col(f"_e{i}") * F.col(f"_e{j}")).alias(f"s_{i}_{j}")
                for i in range(k) for j in range(i, k)]).collect()[0]
            S_full = np.zeros((k, k))
            for i in range(k):
                for j in range(i, k):
                    S_full[i, j] = S_full[j, i] = row[f"s_{i}_{j}"]
        else:
            row = proj.agg(*var_aggs).collect()[0]
        std = np.array([math.sqrt(row[f"v{j}"]) if row[f"v{j}"] is not None else 0.0
                        for j in range(d)])
        scale = np.where(std != 0, 1.0 / np.where(std != 0, std, 1.0), 0.0)
    # scaling and bias as one transform of the statistics
    T = np.zeros((k, k))
    T[:d, :d] = np.diag(scale)
    T[d, d] = 1.0
    T[d + 1, d + 1] = 1.0
    p = d + 1 if intercept else d   # parameters: features (+ bias)
    sel = list(range(d)) + ([d] if intercept else [])

    def split(S: np.ndarray):
        S = T @ S @ T
        return S[np.ix_(sel, sel)], S[sel, d + 1], S[d + 1, d + 1], S[d, d]

    w0 = np.zeros(p)
    if initial_weights is not None:
        w0[:d] = np.asarray(initial_weights, dtype=np.float64)
    if intercept:
        w0[d] = 1.0

    if gradient is not None:
        if mini_batch_fraction < 1 or feature_scaling:
            raise ValueError("another gradient works on full batches of unscaled features")
        terms = [*exprs[:d], *([exprs[d]] if intercept else [])]
        w, iters, losses = _descend(df, terms, y, gradient, w0, num_iterations, step_size,
                                    convergence_tol)
    elif mini_batch_fraction >= 1.0:
        S = S_full if S_full is not None else _collect_square(cross_sums(df, exprs), k)
        A, b, yy, n = split(S)
        if not n > 0:  # the sums of no rows are null
            raise ValueError("training needs at least one row")
        w, iters, losses = _sgd(A, b, yy, w0, num_iterations, step_size, convergence_tol,
                                batch=lambda i: (A, b, yy, n))
    else:
        if mini_batch_fraction * buckets < 1:
            raise ValueError(f"a fraction of {mini_batch_fraction} needs at least "
                             f"{math.ceil(1 / mini_batch_fraction)} buckets")
        key = sample_key if sample_key is not None else F.xxhash64(*[F.col(c) for c in [label, *raw]])
        bucket = F.pmod(key, F.lit(buckets)).cast("int")
        take = int(round(mini_batch_fraction * buckets))
        per = _bucket_stats(df.select(bucket.alias("_b"), *[e.alias(f"_e{j}") for j, e in
                                                            enumerate(exprs)]), k)
        if not per:
            raise ValueError("training needs at least one row")

        def batch(i):
            chosen = sampled_buckets(i, take, buckets)
            S = sum((per[b_] for b_ in chosen if b_ in per), np.zeros((k, k)))
            return split(S)

        w, iters, losses = _sgd(None, None, None, w0, num_iterations, step_size,
                                convergence_tol, batch=batch)
    weights = w[:d] * scale if feature_scaling else w[:d]
    b0 = float(w[d]) if intercept else 0.0
    return LinearModel([float(v) for v in weights], b0, cols, iters, losses)


def _descend(df: DataFrame, terms: list[Column], y: Column,
             gradient: Callable[[Column, Column], Column], w0: np.ndarray, iterations: int,
             step: float, tol: float):
    """Gradient descent on any loss: one aggregate of d sums per iteration."""
    data = df.select(*[t.alias(f"_x{j}") for j, t in enumerate(terms)], y.alias("_y"))
    w, prev, done = w0.astype(np.float64).copy(), None, 0
    for i in range(1, iterations + 1):
        margin = sum((F.col(f"_x{j}") * F.lit(float(v)) for j, v in enumerate(w)), F.lit(0.0))
        slope = data.withColumn("_g", gradient(margin, F.col("_y")))
        row = slope.agg(F.count("*").alias("n"), *[
            F.sum(F.col("_g") * F.col(f"_x{j}")).alias(f"g{j}") for j in range(len(w))]).first()
        if not row["n"]:
            raise ValueError("training needs at least one row")
        w = w - step / math.sqrt(i) * np.array([row[f"g{j}"] for j in range(len(w))]) / row["n"]
        done = i
        if prev is not None and np.linalg.norm(prev - w) < tol * max(np.linalg.norm(w), 1.0):
            break
        prev = w
    return w, done, []


def _mix(iteration: int, buckets: int) -> tuple[int, int]:
    """Odd multiplier and offset of iteration ``i``'s bucket permutation."""
    return 2 * ((iteration * 40503) % max(1, buckets // 2)) + 1, (iteration * 7919) % buckets


def sampled_buckets(iteration: int, take: int, buckets: int = SAMPLE_BUCKETS) -> list[int]:
    """The buckets of mini-batch ``iteration``: b is taken when
    (b * odd + offset) mod B < take — a permutation of the buckets when B is a power of two,
    so exactly ``take`` of them, and plain integer arithmetic any engine can repeat."""
    mult, off = _mix(iteration, buckets)
    return [b for b in range(buckets) if (b * mult + off) % buckets < take]


def _collect_square(long: DataFrame, k: int) -> np.ndarray:
    S = np.zeros((k, k))
    for r in long.collect():  # k^2 rows
        S[r["i"], r["j"]] = r["value"]
    return S


def _bucket_stats(tagged: DataFrame, k: int) -> dict[int, np.ndarray]:
    """k x k sums per bucket in one pass; wide input folds numpy blocks per task."""
    out = {}
    if k > UNROLL_MAX:
        return _bucket_blocks(tagged, k)
    aggs = [F.sum(F.col(f"_e{i}") * F.col(f"_e{j}")).alias(f"s_{i}_{j}")
            for i in range(k) for j in range(i, k)]
    for r in tagged.groupBy("_b").agg(*aggs).collect():  # as many rows as buckets
        S = np.zeros((k, k))
        for i in range(k):
            for j in range(i, k):
                S[i, j] = S[j, i] = r[f"s_{i}_{j}"]
        out[r["_b"]] = S
    return out


def _bucket_blocks(tagged: DataFrame, k: int) -> dict[int, np.ndarray]:
    cols = [f"_e{j}" for j in range(k)]

    def fold(batches):
        got: dict[int, np.ndarray] = {}
        for pdf in batches:
            for b, g in pdf.groupby("_b"):
                x = g[cols].to_numpy(dtype=np.float64)
                got[b] = got.get(b, 0) + x.T @ x
        yield pd.DataFrame({"b": list(got), "s": [v.tobytes() for v in got.values()]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(v, np.float64) for v in pdf["s"])
        return pd.DataFrame({"b": pdf["b"].iloc[:1], "s": [total.tobytes()]})

    ship(tagged.sparkSession)
    schema = "b int, s binary"
    # one block per task and bucket meets in a group; as many blocks as buckets come back
    rows = tagged.mapInPandas(fold, schema).groupBy("b").applyInPandas(add, schema).collect()
    return {r["b"]: np.frombuffer(r["s"], np.float64).reshape(k, k) for r in rows}


def mse(model: LinearModel, df: DataFrame, label: str,
        cols: Sequence[str] | str | None = None) -> DataFrame:
    """Mean squared error of the model on ``df`` (R11): one aggregate."""
    ship(df.sparkSession)
    err = model.predict_col(cols) - F.col(label).cast("double")
    return df.agg(F.avg(err * err).alias("mse"), F.count(F.lit(1)).alias("n"))
