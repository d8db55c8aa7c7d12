"""Exact duplicates by a tree merge of digest runs (operator 6, DataFrame functions only).

Every input partition makes one run: its distinct digests with the identifier
to keep and the number of copies.  In round after round ``fan`` neighbouring
runs are merged, each digest keeping the best identifier, until one run is
left.  Every merge verifies that equal digests come from texts of equal length
and equal second hash, and fails otherwise.  A text that holds a third of all
rows is one row per run from the first aggregate on.  The way back goes down the
same tree: the last run's rows reach the runs by digest (as many rows as runs at
most), and the documents by (run, digest), so that no task gets all copies.

Null text: empty.  Null doc_id: counts as a copy, never as the one that stays;
where all are null, keep_id is null and the rows are dropped ones.  Rows that
repeat the doc_id that stays are all kept.  Empty input: empty result.  Extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statframe.llm.common import id_text, stored

FAN = 16


def _merge(runs: DataFrame, run, best) -> DataFrame:
    got = runs.groupBy(run.alias("run"), "digest").agg(
        best("keep_id").alias("keep_id"), F.sum("n").alias("n"), F.min("size").alias("size"),
        F.max("size").alias("size2"), F.min("check").alias("check"), F.max("check").alias("check2"))
    same = (F.col("size") == F.col("size2")) & (F.col("check") == F.col("check2"))
    return got.select("run", "digest", "keep_id", "n", "check",
                      F.when(same, F.col("size")).otherwise(F.raise_error(F.lit(
                          "two texts share a digest"))).alias("size"))


def exact_dedup(docs: DataFrame, keep: str = "smallest", id_col: str = "doc_id",
                text_col: str = "text", fan: int = FAN) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) of every row; ``keep`` says which doc_id of
    equal texts stays, ``"smallest"`` or ``"largest"``."""
    best = {"smallest": F.min, "largest": F.max}[keep]
    text = F.col("text")
    # stored: the run numbers must be the same on the way down
    leaf = stored(id_text(docs, id_col, text_col).select(
        "doc_id", F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).alias("size"), F.xxhash64(text).alias("check"),
        F.spark_partition_id().alias("run")), "digests")
    first = _merge(leaf.withColumn("keep_id", F.col("doc_id")).withColumn("n", F.lit(1)),
                   F.col("run"), best)
    runs, left = first, (leaf.agg(F.max("run")).first()[0] or 0) + 1
    while left > 1:
        runs = _merge(runs, F.floor(F.col("run") / fan), best)
        left = -(-left // fan)
    top = runs.select("digest", "keep_id", F.col("n").alias("group_size"))
    down = first.select("run", "digest").join(top, "digest")
    return leaf.select("doc_id", "run", "digest").join(down, ["run", "digest"]).select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"), "digest")
