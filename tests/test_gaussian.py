import math

import pytest

from statframe.operators import gaussian as G


def logpdf(spark, g, pts):
    df = spark.createDataFrame(pts, "x double, y double")
    return [r["logpdf"] for r in G.score(df, ["x", "y"], g).collect()]


def test_f17(spark):
    g = G.Gaussian([0.0, 0.0], [[4.0, -1.0], [-1.0, 2.0]])
    assert math.isclose(logpdf(spark, g, [(1.0, 1.0)])[0], -3.3822607123655732, rel_tol=1e-13)


def test_f18_singular(spark):
    g = G.Gaussian([0.0, 0.0], [[1.0, 1.0], [1.0, 1.0]])
    got = logpdf(spark, g, [(1.0, 1.0), (1.0, -1.0)])
    assert math.isclose(got[0], -2.684450656689318, rel_tol=1e-13)
    assert math.isclose(got[1], -2.184450656689318, rel_tol=1e-13)


def test_checks():
    with pytest.raises(ValueError, match="square"):
        G.Gaussian([0.0], [[1.0, 0.0]])
    with pytest.raises(ValueError, match="length"):
        G.Gaussian([0.0, 1.0, 2.0], [[1.0, 0.0], [0.0, 1.0]])


def test_wide_path_equals_literal_path(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    a = rng.normal(size=(20, 20))
    sigma = a @ a.T + np.eye(20)
    g = G.Gaussian(rng.normal(size=20), sigma)
    pts = rng.normal(size=(5, 20))
    df = spark.createDataFrame([(p.tolist(),) for p in pts], "v array<double>")
    wide = sorted(r["logpdf"] for r in G.score(df, "v", g).collect())
    ref = sorted(g.logpdf_np(pts).tolist())
    assert all(math.isclose(x, y, rel_tol=1e-12) for x, y in zip(wide, ref))
