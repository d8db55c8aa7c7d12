"""Inputs, batching and word splitting shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statframe.session import scratch_path
from statframe.ship import ship

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: bytes.translate table: A-Z lowered, every byte outside words turned into a space.  A word
#: byte is 0-9, a-z or any byte of a multi-byte character.
_WORD = bytes(c for c in range(256) if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80)
WORD_TABLE = bytes(
    (c + 32) if 0x41 <= c <= 0x5A else (c if c in _WORD else 0x20) for c in range(256))
#: the same for words split at space and U+0009..U+000D only.
SPACE_TABLE = bytes(
    (c + 32) if 0x41 <= c <= 0x5A else (0x20 if 0x09 <= c <= 0x0D else c) for c in range(256))


def alnum_words(text: str) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text, as UTF-8."""
    return [w for w in text.encode("utf-8", "replace").translate(WORD_TABLE).split(b" ") if w]


def space_words(text: str) -> list[bytes]:
    """Lower-cased words ``[^\\x20\\x09-\\x0D]+`` of a text, as UTF-8."""
    return text.encode("utf-8", "replace").translate(SPACE_TABLE).split()


def lower_az(col: Column) -> Column:
    """A-Z lowered, everything else as it is (``lower`` would also fold other letters)."""
    return F.translate(col, UPPER, LOWER)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator works on; a null text counts as empty.  Other columns,
    whatever their names, are left behind here."""
    ship(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def text_groups(batches: Iterable[pa.RecordBatch], most: int = 1 << 20,
                column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``most`` bytes in ``column``, at least one row each,
    so that a task's memory follows its longest row and not its batch."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        total = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < n:
            base = total[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(total, base + most, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder as Parquet (zstd) and read it again: the lineage is
    cut, later reads keep column pruning, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return placed(spark.read.schema(df.schema).parquet(path), path)


def placed(table: DataFrame, path: str) -> DataFrame:
    """``table``, which remembers that it was written to ``path``."""
    table.stored_at = path
    return table


def forget(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for t in tables:
        path = getattr(t, "stored_at", None)
        if path is None:
            continue
        try:
            jvm, conf = t.sparkSession._jvm, t.sparkSession._jsc.hadoopConfiguration()
        except Exception:  # Spark Connect: the folder is cleared with the session's
            return
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)


def release(spark) -> None:
    """Let Spark remove the shuffle files of finished steps.  It does so when their plans have been
    collected as garbage, which on an idle driver can take half an hour."""
    gc.collect()
    try:
        spark.sparkContext._jvm.System.gc()
    except Exception:  # Spark Connect: the server looks after its own
        return
