"""A training corpus from ``documents`` in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before
kept, and returns the columns of ``documents``; the last returns packed pieces.

1. toxicity        documents whose probability of any severity is at least 0.5 go
2. line_dedup      of each group of fuzzy copies of a line one stays; documents left without
                   any line, or of their lines with blank ones only, go
3. near_dedup      of each component of near-duplicate documents the one with the smallest
                   doc_id stays
4. decontaminate   documents that hold a 10-word window of a benchmark item go
5. pack            the rest is tokenized and packed into sequences of 1024 ids

Rows with a null doc_id, and rows that repeat one, are decided on by their own text.  Null text: empty;
without words no stage finds anything in it, and it is packed as its one separator id.  A text of
any length is taken whole.  Further columns, whatever their names, go along unchanged up to the packing.
Empty documents: empty result; empty labels or benchmark: nothing is toxic or contaminated.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statframe.llm import decontaminate, line_dedup, near_dedup, packing, toxicity
from statframe.llm.common import stored
from statframe.session import table


def _keyed(docs: DataFrame) -> DataFrame:
    """(row, key, text): ``row`` holds all columns; ``key`` stands in for doc_id and differs
    between rows, whatever doc_ids they carry.  Stored, so that keys can't change."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    kept = stored(docs.select(row, F.monotonically_increasing_id().alias("key")), "keyed")
    return kept.select("row", "key", F.col("row.text").alias("text"))


def _rows_of(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``keyed`` whose key is in ``keys``."""
    return keyed.join(keys.select(F.col("doc_id").alias("key")), "key", "left_semi").select("row.*")


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    keyed = _keyed(docs)
    return _rows_of(keyed, toxicity.score(keyed, model, id_col="key").filter("p_toxic < 0.5"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = line_dedup.drop_lines(docs, line_dedup.every_line_links(docs))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        left = left.withColumn("n_chars", F.char_length("text").cast(kind))
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = _keyed(docs)
    found = near_dedup.near_dedup(keyed, id_col="key").select(
        F.col("doc_id").alias("key"), F.col("component_id").alias("component"))
    order = F.struct(F.col("row.doc_id").isNull().alias("no_id"), F.col("row.doc_id"), "key")
    first = keyed.select("key", order.alias("order")).join(found, "key").groupBy("component").agg(
        F.min("order").alias("first"))
    return _rows_of(keyed, first.select(F.col("first.key").alias("doc_id")))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = _keyed(docs)
    found = decontaminate.find_items(keyed, table(spark, sf_dir, "benchmark"), id_col="key")
    return _rows_of(keyed, found.filter(F.size("spans") == 0))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), separator_id=0)


STAGES = [
    ("toxicity", keep_clean),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontaminate", drop_contaminated),
    ("pack", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


#: a trained model and connected components have no SQL form
ORACLE_SQL = None
