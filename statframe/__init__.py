"""statframe: statistics and model fitting as Spark DataFrame operators."""

from statframe.stats import (  # noqa: F401
    chi_sq_test,
    col_stats,
    corr,
    kolmogorov_smirnov_test,
    linear_regression_sgd,
    naive_bayes,
)
