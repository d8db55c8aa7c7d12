"""Two-sample tests over stream windows (T10, re-aimed).

The reference keeps only the result record of a streaming test
(p-value, degrees of freedom as a double, statistic, method, null
hypothesis).  Here the producer is a windowed aggregation: per event-time
window, count / mean / sample variance of the control and the treatment
group (one streaming aggregate with conditional inputs), then Welch's or
Student's t-test on those moments.  The p-value is an Arrow UDF over one row
per window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statframe.functions import special
from statframe.functions.columns import apply_null_policy, not_null
from statframe.ship import ship
from statframe.streaming.summary import event_time

WELCH = "welch"
STUDENT = "student"
METHOD_NAMES = {WELCH: "Welch's 2-sample t-test", STUDENT: "Student's 2-sample t-test"}
NULL_HYPOTHESIS = "Both groups have same mean"


def windowed_moments(stream: DataFrame, value: str, is_treatment: Column, time_col: str,
                     window: str, watermark: str, nulls: str = "error") -> DataFrame:
    """Per window: (n, mean, var) of control (A) and treatment (B); a null value or group is an
    error, or its row is dropped (``nulls="drop"``)."""
    ship(stream.sparkSession)
    if nulls == "drop":
        stream = stream.filter(is_treatment.isNotNull())
    stream = apply_null_policy(stream, [value], nulls)
    v = not_null(F.col(value).cast("double"), value)
    is_treatment = not_null(is_treatment, "the group")
    data = event_time(stream, time_col).withWatermark(time_col, watermark).select(
        F.window(time_col, window).alias("window"), v.alias("_v"), is_treatment.alias("_t"))
    a = F.when(~F.col("_t"), F.col("_v"))
    b = F.when(F.col("_t"), F.col("_v"))
    return data.groupBy("window").agg(
        F.count(a).alias("n_a"), F.avg(a).alias("mean_a"), F.var_samp(a).alias("var_a"),
        F.count(b).alias("n_b"), F.avg(b).alias("mean_b"), F.var_samp(b).alias("var_b"))


def test_columns(method: str) -> list[Column]:
    """p_value, degrees_of_freedom, statistic, method and null_hypothesis from (n, mean, var) of
    control (a) and treatment (b); null where an arm has fewer than two rows or nothing varies."""
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    va, vb = F.col("var_a"), F.col("var_b")
    diff = F.col("mean_a") - F.col("mean_b")
    if method == WELCH:
        sa, sb = va / na, vb / nb
        se2 = sa + sb
        dof = se2 * se2 / (sa * sa / (na - 1) + sb * sb / (nb - 1))
    else:
        dof = na + nb - 2
        pooled = ((na - 1) * va + (nb - 1) * vb) / dof
        se2 = pooled * (F.lit(1.0) / na + F.lit(1.0) / nb)
    enough = (F.col("n_a") > 1) & (F.col("n_b") > 1)
    ok = F.when(enough, se2 > 0).otherwise(F.lit(False))
    stat = F.when(ok, diff / F.sqrt(se2))
    dof = F.when(ok, dof)
    return [special.t_pvalue_udf(stat, dof).alias("p_value"), dof.alias("degrees_of_freedom"),
            stat.alias("statistic"), F.lit(METHOD_NAMES[method]).alias("method"),
            F.lit(NULL_HYPOTHESIS).alias("null_hypothesis")]


def t_test(moments: DataFrame, method: str = WELCH) -> DataFrame:
    """Test rows ``(window_start, window_end, p_value, degrees_of_freedom double,
    statistic, method, null_hypothesis)`` from window moments."""
    if method not in METHOD_NAMES:
        raise ValueError(f"unknown test method {method!r}; use one of {list(METHOD_NAMES)}")
    ship(moments.sparkSession)
    return moments.select(F.col("window.start").alias("window_start"),
                          F.col("window.end").alias("window_end"), *test_columns(method))
