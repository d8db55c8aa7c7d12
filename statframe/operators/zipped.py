"""Pairing two collections by position (DF4-DF6; C3, C4 on two samples).

A DataFrame has no row numbers of its own, and reading a folder of files deals them to tasks in any
order.  ``with_row_index`` therefore writes the rows (each task a file, named by the task's number)
and counts from the files: a row's number is its place in its file plus the rows of all files before.  Only
one count per file is gathered; the numbers do not depend on how the files are read, and an executor
lost later changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statframe.functions.columns import named, quoted, refuse_names
from statframe.operators.correlation import corr_pair
from statframe.session import scratch_path


def with_row_index(df: DataFrame, name: str = "row_index") -> DataFrame:
    """``df`` with a column of row numbers 0, 1, ... in the order of its partitions and rows, which is
    that of a sorted DataFrame.  The rows are written to the shared folder once."""
    refuse_names(df, [name])
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "indexed")
    # one struct: neither the column names nor Parquet's rules on them matter
    df.select(F.struct(*[quoted(c) for c in df.columns]).alias("row")).write.parquet(path)
    kept = spark.read.schema(df.select(F.struct(*[quoted(c) for c in df.columns]).alias(
        "row")).schema).parquet(path).select(
        "row", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    # one row per file, on the driver to be put in order: part-<task>-...
    counts = sorted(((int(r["file"].split("-")[1]), r["file"], r["n"]) for r in
                     kept.groupBy("file").agg(F.count(F.lit(1)).alias("n")).collect()))
    offsets, seen = [], 0
    for _, file, n in counts:
        offsets.append((file, seen))
        seen += n
    table = spark.createDataFrame(offsets, "file string, before long")
    # one row per file goes to the rows, which stay where they are
    return kept.join(F.broadcast(table), "file").select("row.*", (F.col("before") + F.col("at")).alias(name))


def zip_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows of two DataFrames side by side: first with first, second with second.  Unequal lengths are
    an error, as are column names that both have."""
    refuse_names(left, right.columns)
    a, b = with_row_index(left, "_zip_index"), with_row_index(right, "_zip_index")
    n, m = a.count(), b.count()
    if n != m:
        raise ValueError(f"can only zip collections of the same size, not {n} and {m} rows")
    return a.join(b, "_zip_index").drop("_zip_index")


def corr_zipped(x: DataFrame, y: DataFrame, x_col: str, y_col: str, method: str = "pearson",
                nulls: str = "error") -> DataFrame:
    """Correlation of two samples in different DataFrames, paired by position (one row, as
    ``corr_pair``)."""
    both = zip_rows(x.select(named(x, x_col).alias("_x")), y.select(named(y, y_col).alias("_y")))
    out = corr_pair(both, "_x", "_y", method, nulls)
    return out.withColumn("col_i", F.lit(x_col)).withColumn("col_j", F.lit(y_col))
