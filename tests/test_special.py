"""Distribution functions against independent values: exact rational recursions, limits and
identities, over the whole range of arguments."""

import math
from fractions import Fraction

import pytest

from statframe.functions.special import chi2_sf, ks_cdf, ks_pvalue, t_two_sided_p

SIZES = [5, 7, 20, 100, 139, 140, 141, 500, 10 ** 4, 10 ** 6, 10 ** 8, 10 ** 9, 10 ** 11, 10 ** 12]


def exact_ks(d: Fraction, n: int) -> float:
    """n! times the volume where the ordered sample keeps within d, by Durbin's matrix in
    rational arithmetic."""
    k = -((-n * d) // 1)
    h, m = k - n * d, int(2 * k - 1)
    rows = [[Fraction(int(i - j + 1 >= 0)) for j in range(m)] for i in range(m)]
    for i in range(m):
        rows[i][0] -= h ** (i + 1)
        rows[m - 1][i] -= h ** (m - i)
    rows[m - 1][0] += max(Fraction(0), 2 * h - 1) ** m
    rows = [[x / math.factorial(max(0, i - j + 1)) for j, x in enumerate(r)]
            for i, r in enumerate(rows)]
    v = [Fraction(int(i == k - 1)) for i in range(m)]
    for s in range(1, n + 1):
        v = [sum(v[i] * rows[i][j] for i in range(m)) * Fraction(s, n) for j in range(m)]
    return float(v[int(k) - 1])


def limit_ks(z: float) -> float:
    """Kolmogorov's limit distribution in the form that converges for large z."""
    return 1 - 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * z * z) for k in range(1, 200))


@pytest.mark.parametrize("n,d", [(5, "3/10"), (5, "1/2"), (12, "11/40"), (30, "1/5"), (40, "9/80"),
                                 (25, "9/10"), (60, "1/10")])
def test_ks_exact(n, d):
    assert ks_cdf(float(Fraction(d)), n) == pytest.approx(exact_ks(Fraction(d), n), abs=1e-12)


def test_ks_series_meets_the_exact_matrix():
    # 150 > 140: the series is used; its error is of the order of n^-2
    assert ks_cdf(0.08, 150) == pytest.approx(exact_ks(Fraction(2, 25), 150), abs=1e-5)


@pytest.mark.parametrize("n", SIZES)
def test_ks_whole_range(n):
    """No exception, within [0, 1], rising in d, certain far out."""
    ds = sorted({1 / n, 1.5 / n, 1 - 1 / n, 1.0, 0.16, 0.62, 0.9,
                 *(min(1.0, z / math.sqrt(n)) for z in (0.03, 0.2, 0.5, 1, 2, 4, 5))})
    got = [ks_cdf(d, n) for d in ds]
    assert all(0 <= p <= 1 for p in got)
    assert all(a <= b + 1e-9 for a, b in zip(got, got[1:]))
    for d in ds:
        if n * d * d > 20:
            assert ks_pvalue(d, n) == 0
    if n >= 10 ** 6:
        for z in (0.6, 0.9, 1.3, 2.0):
            assert ks_cdf(z / math.sqrt(n), n) == pytest.approx(limit_ks(z), abs=2 / math.sqrt(n))


def test_ks_edges():
    assert ks_cdf(0.05, 10) == 0 and ks_cdf(0.0, 10) == 0
    assert math.isnan(ks_cdf(0.5, 0)) and math.isnan(ks_cdf(math.nan, 5))
    assert ks_cdf(0.1, 10) == pytest.approx(math.factorial(10) / 10 ** 10)
    assert ks_cdf(0.95, 10) == pytest.approx(1 - 2 * 0.05 ** 10)


@pytest.mark.parametrize("df", [1e2, 1e4, 1e6, 1e8, 9e8, 1.1e9, 1e10, 1e12])
def test_chi_squared_at_its_mean(df):
    # median expansion: P(X > df) = 1/2 - 1 / (3 sqrt(pi df)) + O(df^-1.5)
    assert chi2_sf(df, df) == pytest.approx(0.5 - 1 / (3 * math.sqrt(math.pi * df)),
                                            abs=max(1e-8, 0.1 * df ** -1.5))


@pytest.mark.parametrize("z", [-2.0, 0.5, 3.0])
def test_chi_squared_is_smooth_over_the_switch(z):
    tails = [chi2_sf(df + z * math.sqrt(2 * df), df) for df in (0.999e9, 1.001e9)]
    assert tails[0] == pytest.approx(tails[1], abs=1e-7)


def test_student_t_tails():
    assert t_two_sided_p(2, 10) == pytest.approx(0.07338803477074045, abs=1e-12)
    for t in (0.5, 2.0, 4.0):
        assert t_two_sided_p(t, 0.99e6) == pytest.approx(t_two_sided_p(t, 1.01e6), abs=1e-8)
        assert t_two_sided_p(t, 1e12) == pytest.approx(math.erfc(t / math.sqrt(2)), abs=1e-11)
