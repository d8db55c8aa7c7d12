"""Multivariate Gaussian density scoring.

The constants come from a symmetric eigendecomposition of sigma on the
driver (k x k): eigenvalues above tol = eps * max(eig) * k are kept, giving
the log pseudo-determinant and the root pseudo-inverse R = diag(1/sqrt(l)) U';
then logpdf(x) = u - |R (x - mu)|^2 / 2 with u = -(k ln 2pi + log pdet) / 2
(k is the full dimension, also for a singular sigma).

Scoring is a projection: narrow inputs get the k x k literal arithmetic
inside codegen; wider ones a vectorised numpy product per Arrow batch
(``mapInPandas``) — never a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statframe.functions.columns import features, not_null
from statframe.ship import ship

EPSILON = 2.0 ** -52  # double machine epsilon
LITERAL_DIM = 16      # widest input scored with literal arithmetic


class Gaussian:
    def __init__(self, mu: Sequence[float], sigma: Sequence[Sequence[float]]):
        mu = np.asarray(mu, dtype=np.float64)
        sigma = np.asarray(sigma, dtype=np.float64)
        if sigma.ndim != 2 or sigma.shape[0] != sigma.shape[1]:
            raise ValueError("covariance matrix must be square")
        if mu.shape != (sigma.shape[0],):
            raise ValueError("mean vector length must match covariance matrix size")
        self.mu, self.sigma = mu, sigma
        d, u = np.linalg.eigh(sigma)
        tol = EPSILON * d.max() * len(d)
        keep = d > tol
        log_pdet = float(np.log(d[keep]).sum())
        pinv_s = np.where(keep, np.sqrt(1.0 / np.where(keep, d, 1.0)), 0.0)
        self.root = pinv_s[:, None] * u.T
        self.u = -0.5 * (len(mu) * math.log(2.0 * math.pi) + log_pdet)

    @property
    def dim(self) -> int:
        return len(self.mu)

    def logpdf_np(self, x: np.ndarray) -> np.ndarray:
        v = (x - self.mu) @ self.root.T
        return self.u - 0.5 * np.einsum("ij,ij->i", v, v)

    def logpdf_col(self, xs: Sequence[Column]) -> Column:
        """logpdf as literal Column arithmetic (use for small dimensions)."""
        if len(xs) != self.dim:
            raise ValueError(f"expected {self.dim} values, got {len(xs)}")
        deltas = [x - F.lit(float(m)) for x, m in zip(xs, self.mu)]
        quad = None
        for k in range(self.dim):
            vk = None
            for j in range(self.dim):
                c = float(self.root[k, j])
                if c == 0.0:
                    continue
                t = deltas[j] * F.lit(c)
                vk = t if vk is None else vk + t
            if vk is None:
                continue
            sq = vk * vk
            quad = sq if quad is None else quad + sq
        quad = F.lit(0.0) if quad is None else quad
        return F.lit(self.u) - F.lit(0.5) * quad


def score(df: DataFrame, cols, gaussian: Gaussian, output: str = "logpdf",
          density: bool = False, dim: int | None = None) -> DataFrame:
    """``df`` plus the log-density (or density with ``density=True``) of each row."""
    feats = features(df, cols, dim if dim is not None else (gaussian.dim if isinstance(cols, str)
                                                            else None))
    if len(feats) != gaussian.dim:
        raise ValueError(f"expected {gaussian.dim} features, got {len(feats)}")
    xs = [not_null(e, n) for n, e in feats]
    if gaussian.dim <= LITERAL_DIM:
        lp = gaussian.logpdf_col(xs)
    else:  # the array column alone goes to Python, the rest of the row stays where it is
        ship(df.sparkSession)
        x = F.col(cols).cast("array<double>") if isinstance(cols, str) else F.array(*xs)
        lp = _logpdf_udf(gaussian)(x)
    return df.withColumn(output, F.exp(lp) if density else lp)


def _logpdf_udf(g: Gaussian):
    @F.pandas_udf("double")
    def logpdf(x: pd.Series) -> pd.Series:
        if any(v is None or len(v) != g.dim for v in x):
            raise ValueError(f"every array must have {g.dim} values")
        if not len(x):
            return pd.Series([], dtype="float64")
        a = np.stack(x.tolist()).astype(np.float64)
        if np.isnan(a).any() and any(None in list(v) for v in x):
            raise ValueError("null value in an array")
        return pd.Series(g.logpdf_np(a))

    return logpdf


def fit(df: DataFrame, cols, dim: int | None = None) -> Gaussian:
    """Mean and sample covariance from the data (one aggregate), as a Gaussian."""
    from statframe.plans.gram import comoments

    feats = features(df, cols, dim)
    k = len(feats)
    cm = comoments(df, [not_null(e, n) for n, e in feats])
    means = cm.select("n", *[f"mean_{i}" for i in range(k)]).first()  # k numbers, once
    if means is None or means["n"] < 2:
        raise ValueError("fitting a Gaussian needs at least two rows")
    mu = [means[f"mean_{i}"] for i in range(k)]
    sigma = np.zeros((k, k))
    for r in cm.select("i", "j", "value").collect():  # k^2 rows
        sigma[r["i"], r["j"]] = r["value"] / (means["n"] - 1)
    return Gaussian(mu, sigma)


def outliers(df: DataFrame, cols, threshold: float, dim: int | None = None) -> DataFrame:
    """Fit-then-score (G5): logpdf under the data's own Gaussian and a flag for
    rows whose squared Mahalanobis distance exceeds ``threshold``."""
    g = fit(df, cols, dim)
    scored = score(df, cols, g, "logpdf", dim=dim)
    m2 = (F.lit(g.u) - F.col("logpdf")) * 2.0
    return scored.withColumn("is_outlier", m2 > F.lit(float(threshold)))
