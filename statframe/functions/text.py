"""Text to sparse term counts, the feeder for naive Bayes on documents.

Tokens are maximal runs of ASCII letters and digits after lower-casing; the
whole text is tokenised (no prefix or cap).  Output is the long sparse form
``(id, term, tf)``, built with ``regexp_extract_all`` + ``explode`` + a grouped count —
all JVM-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = "[a-z0-9]+"


def term_counts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, term string, tf double)``: occurrences of each term per document."""
    toks = df.select(F.col(id_col).alias(id_col), F.explode(
        F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(TOKEN), 0)).alias("term"))
    return toks.groupBy(id_col, "term").agg(F.count(F.lit(1)).cast("double").alias("tf"))


def term_presence(counts: DataFrame) -> DataFrame:
    """0/1 form of term counts, for Bernoulli naive Bayes."""
    return counts.withColumn("tf", F.lit(1.0))


def tf_idf(counts: DataFrame, id_col: str) -> DataFrame:
    """tf * ln((N + 1) / (df + 1)) with N documents and df documents per term."""
    n_docs = counts.agg(F.count_distinct(id_col).alias("n")).collect()[0]["n"]  # one number
    dfreq = counts.groupBy("term").agg(F.count(F.lit(1)).alias("_df"))
    return (counts.join(dfreq, "term")
            .withColumn("tf", F.col("tf") * F.log((F.lit(n_docs) + 1) / (F.col("_df") + 1)))
            .drop("_df"))
