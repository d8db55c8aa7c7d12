"""Result normalisation for engine-to-engine comparison.

Doubles summed in a different order differ in their last bits, so compared
results are rounded to a number of *significant* digits on both sides, and
-0.0 is mapped to 0.0.  ``sig`` is the Spark Column form and ``sql_sig`` the
matching DuckDB SQL text: both scale by an exact power of ten, round half
away from zero, and scale back, so equal inputs give bit-equal outputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 10


def sig(c: Column, digits: int = DIGITS, scale: Column | None = None) -> Column:
    """``c`` to ``digits`` significant digits, of its own magnitude or of ``scale``'s: a value that is
    the difference of far larger sums has no digits of its own below theirs."""
    a = F.abs(c if scale is None else scale)
    k = F.lit(digits - 1) - F.floor(F.log10(a))
    up = F.round(c * F.pow(F.lit(10.0), k), 0) / F.pow(F.lit(10.0), k)
    down = F.round(c / F.pow(F.lit(10.0), -k), 0) * F.pow(F.lit(10.0), -k)
    return (F.when(c.isNull(), F.lit(None).cast("double"))
            .when((c == 0) | (a == 0), F.lit(0.0))
            .when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), c)
            .when(k >= 0, up)
            .otherwise(down))


def sql_sig(x: str, digits: int = DIGITS, scale: str | None = None) -> str:
    size = f"abs({scale or x})"
    k = f"({digits - 1} - floor(log10({size})))"
    return (f"(CASE WHEN ({x}) IS NULL THEN NULL WHEN ({x}) = 0 OR {size} = 0 THEN 0.0 "
            f"WHEN isnan({x}) OR isinf({x}) THEN ({x}) "
            f"WHEN {k} >= 0 THEN round(({x}) * pow(10.0, {k}), 0) / pow(10.0, {k}) "
            f"ELSE round(({x}) / pow(10.0, -{k}), 0) * pow(10.0, -{k}) END)")


#: digits of a covariance or correlation matrix, counted from sigma_i * sigma_j
MATRIX_DIGITS = 9


def rounded_matrix(df: DataFrame, value: str, digits: int = MATRIX_DIGITS) -> DataFrame:
    """Round a long (i, j, value) matrix relative to sqrt(value_ii * value_jj): an entry off the
    diagonal is only determined to the rounding errors of sums of that size."""
    side = df.filter(F.col("i") == F.col("j")).select("i", F.sqrt(F.abs(value)).alias("_s"))
    scale = F.col("_si") * F.col("_sj")
    both = df.join(side.select("i", F.col("_s").alias("_si")), "i").join(
        side.select(F.col("i").alias("j"), F.col("_s").alias("_sj")), "j")
    out = F.when(sig(F.col(value), digits, scale) == 0, F.lit(0.0)).otherwise(
        sig(F.col(value), digits, scale))
    return both.select(*[out.alias(c) if c == value else F.col(c) for c in df.columns])


def sql_rounded_matrix(inner: str, value: str, digits: int = MATRIX_DIGITS) -> str:
    """The same for a DuckDB query of (i, j, value) with 32-bit i and j."""
    x = sql_sig(f"m.{value}", digits, "(a.s * b.s)")
    return (f"WITH m AS ({inner}), side AS (SELECT i, sqrt(abs({value})) AS s FROM m WHERE i = j) "
            f"SELECT m.i, m.j, CASE WHEN {x} = 0 THEN 0.0 ELSE {x} END AS {value} FROM m "
            f"JOIN side AS a ON a.i = m.i JOIN side AS b ON b.i = m.j")


P_DECIMALS = 9
ABSOLUTE = ("p_value", "probability")  # probabilities: round to decimals


def pround(c: Column, decimals: int = P_DECIMALS) -> Column:
    r = F.round(c, decimals)
    return F.when(r == 0, F.lit(0.0)).otherwise(r)


def sql_pround(x: str, decimals: int = P_DECIMALS) -> str:
    return f"(CASE WHEN round({x}, {decimals}) = 0 THEN 0.0 ELSE round({x}, {decimals}) END)"


def rounded(df: DataFrame, digits: int = DIGITS, only: list[str] | None = None) -> DataFrame:
    """Round every double column (or those in ``only``) to ``digits`` significant
    digits; p-value columns to P_DECIMALS decimals."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType) and f.name in ABSOLUTE:
            out.append(pround(F.col(f.name)).alias(f.name))
        elif isinstance(f.dataType, T.DoubleType) and (only is None or f.name in only):
            out.append(sig(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
