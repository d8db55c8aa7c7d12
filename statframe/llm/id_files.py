"""Token-id files with Elias-Fano document boundaries (operator 5).

Documents are encoded, put in ascending doc_id order and written as blocks.  A
block is one record of a Parquet file:

* ``ids``       the ids of its documents one after another, 2 bytes each where the
                vocabulary allows it, else 4 (``id_bytes``)
* ``ends``      Elias-Fano code of the documents' end offsets in the block
* ``docs``      Elias-Fano code of doc_id - ``first_doc`` (null ids come first; ``n_null``)
* ``shard``, ``block``, ``n_docs``, ``n_ids``, ``before`` (the shard's ids before the block)

An Elias-Fano code keeps the low bits of each value packed side by side and the
high bits in unary, about ``2 + log2(range / n)`` bits a value in all; ``EliasFano.select``
gives the i-th value back with the help of one sampled position per 256 values.
No table of 64-bit offsets is written.  A shard is one range of doc_ids; the
shards' first offsets follow from one sum per shard (as many rows as shards).

Null text: empty, so only the end id.  Null doc_id: sorts first.  Repeated
doc_ids: all kept, next to each other, in text order.  Empty input: no blocks.
"""

from __future__ import annotations

import struct
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statframe.llm.common import forget, id_text, stored, text_groups
from statframe.llm.token_cache import TEXT_BYTES, id_cache, library_tokenizer

#: ids a block holds, unless one document has more
BLOCK_IDS = 1 << 20
#: one sampled position in the high bits per so many values
SAMPLE = 256

BLOCK_SCHEMA = ("shard int, block int, n_docs long, n_null long, first_doc long, n_ids long, "
                "before long, id_bytes int, docs binary, ends binary, ids binary")


class EliasFano:
    """Non-decreasing whole numbers in near-minimal space."""

    HEAD = struct.Struct("<QBQ")

    def __init__(self, data: bytes):
        self.n, self.low_bits, n_high = self.HEAD.unpack_from(data)
        at = self.HEAD.size
        n_low = (self.n * self.low_bits + 7) // 8
        self.low = np.frombuffer(data, np.uint8, n_low, at)
        self.high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        self.samples = np.frombuffer(data, "<u4", -1, at + n_low + n_high)

    @classmethod
    def encode(cls, values: np.ndarray) -> bytes:
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        top = int(v[-1]) if n else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = b""
        if n and bits:
            shifts = np.arange(bits, dtype=np.uint64)
            low = np.packbits(((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8),
                              bitorder="little").tobytes()
        ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        unary[ones] = 1
        high = np.packbits(unary, bitorder="little").tobytes()
        return cls.HEAD.pack(n, bits, len(high)) + low + high + ones[::SAMPLE].astype("<u4").tobytes()

    def _low(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.uint64)
        for b in range(self.low_bits):
            bit = at * self.low_bits + b
            out |= ((self.low[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(np.uint64) \
                << np.uint64(b)
        return out

    def select(self, i: int) -> int:
        """The i-th value, from the sampled position before it on."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self.samples[i // SAMPLE])
        left, byte = i % SAMPLE, at >> 3
        bits = np.unpackbits(self.high[byte:byte + 1], bitorder="little")
        bits[:at & 7] = 0
        while (ones := int(bits.sum())) <= left:
            left, byte = left - ones, byte + 1
            bits = np.unpackbits(self.high[byte:byte + 1], bitorder="little")
        place = byte * 8 + int(np.flatnonzero(bits)[left])
        return (place - i) << self.low_bits | int(self._low(np.array([i]))[0])

    def all(self) -> np.ndarray:
        """All values."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        at = np.arange(self.n)
        return ((ones - at).astype(np.uint64) << np.uint64(self.low_bits) | self._low(at)).astype(
            np.int64)


def encode_documents(docs: DataFrame, vocab: str, end_id: int, id_col: str = "doc_id",
                     text_col: str = "text", id_bytes: int = 4) -> DataFrame:
    """(doc_id, ids): every text's ids and ``end_id``, little-endian unsigned, ``id_bytes`` each."""
    def run(batches):
        cache = id_cache(vocab)
        for b in text_groups(batches, TEXT_BYTES):
            ids, ends = cache.batch(b.column("text"), end_id)
            data = pa.py_buffer(ids.astype(f"<u{id_bytes}", copy=False))
            at = pa.py_buffer(np.append(0, ends * id_bytes))
            coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, at, data])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), coded.cast(pa.binary())],
                                             names=["doc_id", "ids"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary")


def write_id_files(docs: DataFrame, path: str, vocab: str, end_id: int, id_col: str = "doc_id",
                   text_col: str = "text", shards: int | None = None,
                   block_ids: int = BLOCK_IDS) -> None:
    """Write the id files of ``docs`` to the shared folder ``path``; ``shards`` (default: the
    session's shuffle partitions) is the number of doc_id ranges."""
    width = 2 if max(library_tokenizer(vocab).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    # encoded once: the range bounds are sampled from the stored rows, not from a second encoding; to
    # their width in the same worker, as a second one a task would need memory of its own
    coded = stored(encode_documents(docs, vocab, end_id, id_col, text_col, width), "coded")
    n = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def block(shard, k, before, doc_ids, parts):
        known = np.array([d for d in doc_ids if d is not None], np.int64)
        first = int(known[0]) if len(known) else 0
        ends = np.cumsum([len(p) // width for p in parts])
        gaps = known.astype(np.uint64) - np.uint64(first & 0xFFFFFFFFFFFFFFFF)
        return [shard, k, len(parts), len(parts) - len(known), first, int(ends[-1]), before, width,
                EliasFano.encode(gaps), EliasFano.encode(ends), b"".join(parts)]

    def blocks(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        names = [f.split()[0] for f in BLOCK_SCHEMA.split(", ")]
        types = [pa.int32(), pa.int32(), *[pa.int64()] * 5, pa.int32(), *[pa.binary()] * 3]
        ids, parts, held, k, before = [], [], 0, 0, 0

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(block(shard, k, before, ids, parts), types)], names=names)

        for b in batches:
            for d, x in zip(b.column("doc_id").to_pylist(), b.column("ids").to_pylist()):
                if parts and held + len(x) // width > block_ids:
                    yield out()
                    ids, parts, held, k, before = [], [], 0, k + 1, before + held
                ids.append(d)
                parts.append(x)
                held += len(x) // width
        if parts:
            yield out()

    # three copies of the ids lie on disk here, the stored one, the shuffled one and the files: ids take a
    # quarter less as zstd than as snappy
    (coded.repartitionByRange(n, F.col("doc_id").asc_nulls_first())
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "ids")
     .mapInArrow(blocks, BLOCK_SCHEMA).write.option("compression", "zstd").parquet(path))
    forget(coded)


def read_id_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): the documents of id files; ids as little-endian unsigned
    32-bit, ``start`` the number of ids of all documents before."""
    files = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    # one row per shard comes back: as many as the ranges that were asked for when writing
    sizes = files.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    begin = dict(zip((r.shard for r in sizes), accumulate((r.n for r in sizes), initial=0)))

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                ends = EliasFano(r["ends"]).all()
                known = EliasFano(r["docs"]).all() + r["first_doc"]
                ids = np.frombuffer(r["ids"], f"<u{r['id_bytes']}").astype("<u4", copy=False)
                lo = np.concatenate([[0], ends[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([None] * r["n_null"] + known.tolist(), pa.int64()),
                     pa.array(lo + begin[r["shard"]] + r["before"], pa.int64()), pa.array(ends - lo, pa.int64()),
                     pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [
                         None, pa.py_buffer(4 * np.append(0, ends)), pa.py_buffer(ids)]).cast(pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])

    return files.mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary")


