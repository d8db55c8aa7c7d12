"""Scalar special functions for p-values, plus their Arrow (pandas) UDF forms.

Spark SQL has no erf, lgamma or incomplete gamma, so these run as
vectorised pandas UDFs over *result rows* (one row per test or feature) or,
for the normal CDF, over distinct sample values.  Only the standard library
and numpy are used.

* ``chi2_sf(x, df)``  — upper tail of chi-squared, Q(df/2, x/2) by the
  series / Lentz continued fraction of the regularized incomplete gamma.
* ``norm_cdf(x, mu, sigma)`` — 0.5 erfc(-(x-mu)/(sigma sqrt 2)), with the
  +-40 sigma cut of the usual implementation.
* ``ks_cdf(d, n)`` — P(D_n <= d) of the one-sample two-sided Kolmogorov
  statistic: exact closed forms near 0 and 1, 1 once n d^2 > 18 (the tail is
  below 2 exp(-36)), the Durbin matrix method with rescaling for n <= 140 and
  the Pelz-Good asymptotic series, summed to convergence, above (Simard &
  L'Ecuyer 2011 give both; the split at 140 is the usual choice).

All sums run until their terms no longer matter; where that would take too
many terms (degrees of freedom beyond ``LARGE_DF``) a normal approximation
with an error below 1e-9 takes over.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPS = 1e-15
LARGE_DF = 1e9       # chi-squared: beyond, Wilson-Hilferty's cube-root normal form
LARGE_T_DF = 1e6     # Student t: beyond, the normal tail of the corrected quantile
KS_TAIL = 18.0       # n d^2 from which P(D_n > d) <= 2 exp(-36) counts as 0


def _power_term(a: float, x: float) -> float:
    """x^a e^-x / Gamma(a), without the cancellation of lgamma at large a."""
    if a < 100:
        return math.exp(-x + a * math.log(x) - math.lgamma(a))
    u = (x - a) / a
    stirling = 1 / (12 * a) - 1 / (360 * a ** 3) + 1 / (1260 * a ** 5)
    return math.exp(-a * (u - math.log1p(u)) - stirling) * math.sqrt(a / (2 * math.pi))


def _gamma_p_series(a: float, x: float) -> float:
    term = 1.0 / a
    total = term
    ap = a
    while abs(term) >= abs(total) * EPS:
        ap += 1.0
        term *= x / ap
        total += term
    return total * _power_term(a, x)


def _gamma_q_fraction(a: float, x: float) -> float:
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    i, delta = 0, 0.0
    while abs(delta - 1.0) >= EPS:
        i += 1
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        if abs(d) < tiny:
            d = tiny
        c = b + an / c
        if abs(c) < tiny:
            c = tiny
        d = 1.0 / d
        delta = d * c
        h *= delta
    return _power_term(a, x) * h


def gamma_q(a: float, x: float) -> float:
    """Regularized upper incomplete gamma Q(a, x)."""
    if math.isnan(a) or math.isnan(x) or a <= 0 or x < 0:
        return math.nan
    if x == 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    if x < a + 1.0:
        return 1.0 - _gamma_p_series(a, x)
    return _gamma_q_fraction(a, x)


def chi2_sf(x: float, df: float) -> float:
    """P(X > x) for X ~ chi-squared(df)."""
    if x is None or df is None:
        return math.nan
    if df > LARGE_DF and 0 < x < math.inf:
        v = 2.0 / (9.0 * df)
        z = ((x / df) ** (1.0 / 3.0) - (1.0 - v)) / math.sqrt(v)
        return 0.5 * math.erfc(z / math.sqrt(2.0))
    return gamma_q(df / 2.0, x / 2.0)


def norm_cdf(x: float, mu: float = 0.0, sigma: float = 1.0) -> float:
    dev = x - mu
    if abs(dev) > 40 * sigma:
        return 0.0 if dev < 0 else 1.0
    return 0.5 * math.erfc(-dev / (sigma * math.sqrt(2.0)))


def _beta_fraction(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    m, delta = 0, 0.0
    while abs(delta - 1.0) >= EPS:
        m += 1
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
    return h


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta I_x(a, b) (continued fraction)."""
    if math.isnan(x) or x < 0 or x > 1:
        return math.nan
    if x == 0 or x == 1:
        return x
    ln_front = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(ln_front) * _beta_fraction(a, b, x) / a
    return 1.0 - math.exp(ln_front) * _beta_fraction(b, a, 1.0 - x) / b


def t_two_sided_p(t: float, df: float) -> float:
    """P(|T| >= |t|) for Student's t with ``df`` degrees of freedom."""
    if math.isnan(t) or math.isnan(df) or df <= 0:
        return math.nan
    if math.isinf(t):
        return 0.0
    if df > LARGE_T_DF:
        z = abs(t) * (1.0 - 0.25 / df) / math.sqrt(1.0 + t * t / (2.0 * df))
        return math.erfc(z / math.sqrt(2.0))
    return beta_inc(df / 2.0, 0.5, df / (df + t * t))


# ------------------------------------------------------------------ KS


def _scaled_product(a, ea: int, b, eb: int):
    """a 2^ea times b 2^eb as (matrix, exponent), entries kept near 1."""
    c = a @ b
    top = float(np.abs(c).max())
    shift = math.frexp(top)[1] if top > 0 else 0
    return np.ldexp(c, -shift), ea + eb + shift


def _ks_matrix(d: float, n: int) -> float:
    """Durbin's matrix method, n! / n^n (H^n)[k, k], with an exponent carried beside every
    matrix so that nothing over- or underflows."""
    k = math.ceil(n * d)
    m = 2 * k - 1
    h = k - n * d
    # 1 / (i - j + 1)! on and below the superdiagonal
    inverse = np.cumprod(np.concatenate([[1.0], 1.0 / np.arange(1, m + 1)]))
    order = np.arange(m)[:, None] - np.arange(m)[None, :] + 1
    H = np.where(order >= 0, inverse[np.maximum(order, 0)], 0.0)
    edge = h ** np.arange(1, m + 1) * inverse[1:]
    H[:, 0] -= edge
    H[m - 1, :] -= edge[::-1]
    # the corner lost h^m twice; it is 1 - 2 h^m + max(0, 2h - 1)^m over m!
    H[m - 1, 0] = (1 - 2 * h ** m + max(0.0, 2 * h - 1) ** m) * inverse[m]
    power, exponent, base, eb, left = np.eye(m), 0, H, 0, n
    while left:
        if left & 1:
            power, exponent = _scaled_product(power, exponent, base, eb)
        left >>= 1
        if left:
            base, eb = _scaled_product(base, eb, base, eb)
    middle = float(power[k - 1, k - 1])
    if middle <= 0:
        return 0.0
    log_p = (math.log(middle) + exponent * math.log(2.0) + math.lgamma(n + 1) - n * math.log(n))
    return min(1.0, math.exp(log_p))


def _pelz_good(d: float, n: int) -> float:
    """Pelz and Good's series K0 + K1 / sqrt(n) + K2 / n + K3 / n^1.5 at z = d sqrt(n)."""
    z = d * math.sqrt(n)
    # e^(-pi^2 / (8 z^2)), the largest term of any of the sums, is 0 in double precision
    if z < 0.04:
        return 0.0
    pi2, w = math.pi ** 2, z * z
    # terms past this index are below e^-745, the smallest double
    last = math.ceil(z * math.sqrt(2 * 745) / math.pi) + 2
    half = (np.arange(last) + 0.5) ** 2
    whole = np.arange(1, last + 1, dtype=np.float64) ** 2
    with np.errstate(under="ignore"):
        at_half, at_whole = np.exp(-pi2 * half / (2 * w)), np.exp(-pi2 * whole / (2 * w))

    def over_half(*coefficients):
        """Sum over k of a polynomial in pi^2 (k + 1/2)^2 times the exponential."""
        return float((np.polynomial.polynomial.polyval(pi2 * half, coefficients) * at_half).sum())

    def over_whole(*coefficients):
        return float((np.polynomial.polynomial.polyval(pi2 * whole, coefficients)
                      * at_whole).sum())

    root = math.sqrt(math.pi / 2)
    k0 = 2 * root / z * over_half(1.0)
    k1 = root / (3 * w ** 2) * over_half(-w, 1.0)
    k2 = root * (over_half(6 * w ** 3 + 2 * w ** 2, 2 * w ** 2 - 5 * w, 1 - 2 * w)
                 / (36 * w ** 3 * z) - over_whole(0.0, 1.0) / (18 * w * z))
    k3 = root * (over_half(-30 * w ** 3 - 90 * w ** 4, 135 * w ** 2 - 96 * w ** 3,
                           -60 * w + 212 * w ** 2, 5 - 30 * w) / (3240 * w ** 5)
                 + over_whole(0.0, 3 * w, -1.0) / (108 * w ** 3))
    total = k0 + k1 / math.sqrt(n) + k2 / n + k3 / (n * math.sqrt(n))
    return min(1.0, max(0.0, total))


def ks_cdf(d: float, n: int) -> float:
    """P(D_n <= d) for the one-sample two-sided Kolmogorov-Smirnov statistic."""
    if n <= 0 or math.isnan(d):
        return math.nan
    edge = 2 * n * d - 1
    if edge <= 0:
        return 0.0
    if d >= 1 or n * d * d > KS_TAIL:
        return 1.0
    if edge <= 1:  # n! (2d - 1/n)^n
        return math.exp(math.lgamma(n + 1) + n * (math.log(edge) - math.log(n)))
    if d >= 1 - 1 / n:
        return 1 - 2 * (1 - d) ** n
    if n <= 140:
        return _ks_matrix(d, n)
    return _pelz_good(d, n)


def ks_pvalue(d: float, n: int) -> float:
    return 1.0 - ks_cdf(d, n)


# -------------------------------------------------------- Arrow UDF forms


@F.pandas_udf(T.DoubleType())
def chi2_sf_udf(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf(float(x), float(k)) if pd.notna(x) and pd.notna(k) else math.nan
                      for x, k in zip(stat, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def t_pvalue_udf(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided_p(float(t), float(k)) if pd.notna(t) and pd.notna(k)
                      else math.nan for t, k in zip(stat, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def ks_pvalue_udf(stat: pd.Series, n: pd.Series) -> pd.Series:
    return pd.Series([ks_pvalue(float(d), int(k)) for d, k in zip(stat, n)], dtype="float64")


ERF_SERIES_TERMS = 200  # enough for |x| < 6, beyond which erf is +-1 to 2e-17
ERF_CUT = 6.0


def std_norm_cdf_np(z: np.ndarray) -> np.ndarray:
    """Standard normal CDF of an array, vectorised: 0.5 (1 + erf(z / sqrt 2))
    with erf(x) = 2/sqrt(pi) e^(-x^2) sum_k 2^k x^(2k+1) / (2k+1)!!, a series
    of positive terms (absolute error ~1e-16, which is what a KS distance
    needs); |x| >= 6 gives erf = +-1 and |z| > 40 gives 0 or 1."""
    z = np.asarray(z, dtype=np.float64)
    x = z / math.sqrt(2.0)
    ax = np.minimum(np.abs(x), ERF_CUT)
    term = ax.copy()
    total = ax.copy()
    x2 = 2.0 * ax * ax
    for k in range(1, ERF_SERIES_TERMS):
        term = term * x2 / (2 * k + 1)
        total = total + term
        if k > 8 and not (term > 1e-17 * total).any():  # every term negligible
            break
    erf = np.where(np.abs(x) >= ERF_CUT, 1.0,
                   2.0 / math.sqrt(math.pi) * np.exp(-ax * ax) * total)
    out = 0.5 * (1.0 + np.sign(x) * erf)
    return np.where(z < -40, 0.0, np.where(z > 40, 1.0, out))


@F.pandas_udf(T.DoubleType())
def _std_norm_cdf_udf(z: pd.Series) -> pd.Series:
    return pd.Series(std_norm_cdf_np(z.to_numpy(dtype=np.float64)))


def norm_cdf_col(x: Column, mu: float = 0.0, sigma: float = 1.0) -> Column:
    """Normal CDF as a Column (Arrow UDF on the standardised value)."""
    if not sigma > 0:
        raise ValueError("standard deviation must be positive")
    return _std_norm_cdf_udf((x - F.lit(float(mu))) / F.lit(float(sigma)))


def numpy_cdf(fn) -> "Callable[[Column], Column]":
    """Wrap a vectorised numpy CDF (array -> array) as a Column -> Column
    function for ``ks_test``: evaluated per Arrow batch of distinct values."""
    @F.pandas_udf(T.DoubleType())
    def _cdf(v: pd.Series) -> pd.Series:
        return pd.Series(np.asarray(fn(v.to_numpy(dtype=np.float64)), dtype=np.float64))

    return lambda c: _cdf(c)
