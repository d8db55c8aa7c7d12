"""One-stop entry points with the reference's shape: summaries, correlation,
chi-squared and Kolmogorov-Smirnov tests, and the two trainers.

Each call returns DataFrames (or a model whose tables are DataFrames); see
the operator modules for the plans.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame

from statframe.operators import bayes, correlation, hypothesis, linear, summary


def col_stats(df: DataFrame, cols, weight: str | None = None, group_by: Sequence[str] = (),
              nulls: str = "error") -> DataFrame:
    """Column summary: count, mean, variance, nonzeros, max, min, L1, L2 per column."""
    return summary.col_summary(df, cols, weight=weight, group_by=group_by, nulls=nulls)


def corr(df: DataFrame, x, y: str | None = None, method: str = "pearson",
         nulls: str = "error") -> DataFrame:
    """Correlation matrix of columns ``x`` (a list or an array column), or the
    correlation of the two columns ``x`` and ``y`` (one row)."""
    if y is not None:
        return correlation.corr_pair(df, x, y, method, nulls)
    return correlation.corr(df, x, method, nulls)


def chi_sq_test(data: DataFrame, expected: DataFrame | None = None, *,
                label: str | None = None, features: Sequence[str] | None = None,
                row: str | None = None, col: str | None = None, count: str = "count",
                category: str = "category", observed: str = "observed",
                expected_col: str = "expected", method: str = hypothesis.PEARSON) -> DataFrame:
    """Pearson chi-squared test, chosen by the arguments:

    * ``label`` + ``features``: independence of every feature from the label;
    * ``row`` + ``col``: independence on a contingency table in long form;
    * otherwise goodness of fit of ``observed`` counts per ``category``
      against ``expected`` (or the uniform distribution).
    """
    if label is not None or features is not None:
        if label is None or not features:
            raise ValueError("feature tests need both label and features")
        return hypothesis.chisq_features(data, label, features, method)
    if row is not None or col is not None:
        return hypothesis.chisq_independence(data, row or "row", col or "col", count, method)
    return hypothesis.chisq_gof(data, expected, category, observed, expected_col, method)


def kolmogorov_smirnov_test(df: DataFrame, col: str,
                            cdf: Callable[[Column], Column] | str = "norm",
                            *params: float) -> DataFrame:
    """One-sample, two-sided KS test against a CDF expression or ``"norm"``."""
    return hypothesis.ks_test(df, col, cdf, *params)


def naive_bayes(df: DataFrame, label: str, cols: Sequence[str], smoothing: float = 1.0,
                model_type: str = bayes.MULTINOMIAL) -> bayes.NaiveBayesModel:
    """Train multinomial (default) or Bernoulli naive Bayes on dense rows."""
    return bayes.fit(df, label, cols, model_type, smoothing)


def linear_regression_sgd(df: DataFrame, label: str, cols: Sequence[str],
                          num_iterations: int = 100, step_size: float = 1.0,
                          mini_batch_fraction: float = 1.0,
                          initial_weights: Sequence[float] | None = None,
                          intercept: bool = False) -> linear.LinearModel:
    """Least squares by gradient descent with the reference's defaults."""
    return linear.train_sgd(df, label, cols, num_iterations, step_size, mini_batch_fraction,
                            initial_weights, intercept)
