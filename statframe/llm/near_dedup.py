"""Near-duplicate documents by fast similarity sketches (operator 2).

A document's set holds its distinct runs of ``words`` consecutive words, as 64-bit hashes.  The
sketch has one coordinate per bin.  In each round all elements of the set are placed into bins by
a fresh hash, and an empty bin takes the smallest of its elements; after as many
rounds as there are bins, each further round places all elements into one bin, so every
coordinate fills.  Two sets agree in a coordinate with the probability of their similarity.

Documents with the same set are one node.  Nodes that agree in all coordinates of one of
``bands`` bands share a bucket (at a similarity of 0.75, 4 coordinates a band and 40 bands miss
a pair once in four million); buckets are linked as in ``linking``, each pair confirmed on the
full sets of its texts.

Null text, no words: empty set, linked with nothing.  Fewer than ``words`` words: the whole
sequence is the one element.  Null doc_id: takes part in links, but is never a component's id
unless all its members are null.  Repeated doc_ids: each row by itself.  Empty input: empty
result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statframe.llm.common import id_text, space_words, stored, text_groups
from statframe.llm.linking import PARITIES, link, marked

BANDS, ROWS = 40, 4

_U = np.uint64
_ODD = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit values."""
    x = x ^ _U((seed + 1) * _ODD[0] & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _U(30))) * _U(_ODD[1])
    x = (x ^ (x >> _U(27))) * _U(_ODD[2])
    return x ^ (x >> _U(31))


class ShingleSets:
    """Sets of texts; remembers words' hashes, ``most`` at a time."""

    def __init__(self, words: int, most: int = 300_000):
        self.words, self.most, self.known = words, most, {}

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        known = self.known
        if len(known) > self.most:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def of(self, text: str) -> np.ndarray:
        """The sorted set of one text."""
        h = self._hashes(space_words(text))
        n = min(self.words, len(h))
        if not n:
            return h
        out = np.full(len(h) - n + 1, n, np.uint64)
        for j in range(n):
            out = _mix(out + h[j:len(h) - n + 1 + j], j)
        return np.unique(out)


def sketches(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """One row of ``bins`` coordinates per non-empty set."""
    size = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    doc = np.repeat(np.arange(len(sets)), size)
    empty = np.iinfo(np.uint64).max
    out = np.full((len(sets), bins), empty, np.uint64)
    for r in range(2 * bins):
        h = _mix(every, r + 1)
        # the round stands above the value: a bin keeps what it got first
        value = (_U(r) << _U(48)) | (h & _U((1 << 48) - 1))
        place = ((h >> _U(48)) * _U(bins) >> _U(16)).astype(np.int64) if r < bins else r - bins
        np.minimum.at(out.reshape(-1), doc * bins + place, value)
        open_ = (out == empty).any(axis=1)
        if not open_.any():
            break
        if r % 4 == 0:  # later rounds only for sets with empty bins
            keep = open_[doc]
            every, doc = every[keep], doc[keep]
    return out


def band_keys(sketch: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band and set."""
    parts = sketch.reshape(len(sketch), bands, -1)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), parts.shape[:2])
    for j in range(parts.shape[2]):
        key = _mix(key + parts[:, :, j], 1000 + j)
    return key.astype(np.int64)


def parities(s: np.ndarray) -> np.ndarray:
    """Bit b of 64 * PARITIES: whether an odd number of a set's elements has hash b."""
    odd = np.bincount((s % _U(64 * PARITIES)).astype(np.int64), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _digest(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def near_dedup(docs: DataFrame, words: int = 5, percent: int = 75, bands: int = BANDS,
               rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; documents are linked where 100 times the
    sets' intersection is at least ``percent`` times their union."""
    texts = id_text(docs, id_col, text_col)

    def sketch(batches):
        sets = ShingleSets(words)
        for b in text_groups(batches):
            got = [sets.of(t) for t in b.column("text").to_pylist()]
            full = [s for s in got if len(s)]
            keys = iter(band_keys(sketches(full, bands * rows), bands)) if full else iter(())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(s) for s in got], pa.int64()),
                 pa.array([_digest(s) if len(s) else None for s in got], pa.binary()),
                 pa.array([next(keys) if len(s) else None for s in got], pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "digest", "keys"])

    rows_ = stored(texts.mapInArrow(
        sketch, "doc_id long, n_shingles long, digest binary, keys array<long>"), "sketches")
    nodes = stored(rows_.filter(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"),
        F.first("keys").alias("keys")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    buckets = nodes.select(F.explode("keys").alias("key"), "node", F.col("n").alias("size"))
    # the texts of nodes that share a bucket; other nodes need none
    busy = buckets.join(buckets.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1"),
                        "key").select("key", "node", "size")
    busy = stored(busy, "busy")
    wanted = nodes.select("node", "first_id", "digest").join(
        busy.select("node").distinct(), "node", "left_semi")

    def sets_of(batches):
        sets = ShingleSets(words)
        for b in text_groups(batches):
            d = b.to_pydict()
            every = [sets.of(t) for t in d["text"]]
            keep = [i for i, (s, h) in enumerate(zip(every, d["digest"])) if _digest(s) == h]
            kept = b.select(["node", "text"]).take(pa.array(keep, pa.int64()))
            marks = [parities(every[i]) for i in keep]
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array([len(every[i]) for i in keep], pa.int64()),
                 pa.array(marks, pa.list_(pa.int64()))], names=["node", "text", "size", "marks"])

    # several rows may carry a wanted doc_id; those of another set are left out
    content = stored(texts.join(wanted, texts.doc_id.eqNullSafe(wanted.first_id))
                     .select("node", "digest", "text").mapInArrow(
                         sets_of, "node long, text string, size long, marks array<long>")
                     .dropDuplicates(["node"]), "texts")
    marks = content.select("node", "size", *[F.get("marks", F.lit(i)).alias(f"p{i}")
                                             for i in range(PARITIES)])

    def compare(batches):
        sets = ShingleSets(words)
        at, hub = None, None
        for b in text_groups(batches, column="text_a"):
            a, n, t, u = (c.to_pylist() for c in b.columns)
            far, linked = [], []
            for i in range(len(a)):
                if n[i] != at:  # rows of one hub mostly come one after another
                    at, hub = n[i], sets.of(u[i])
                own = sets.of(t[i])
                both = len(np.intersect1d(own, hub, assume_unique=True))
                union = len(own) + len(hub) - both
                far.append(1 - both / union)
                linked.append(100 * both >= percent * union)
            yield pa.RecordBatch.from_arrays(
                [b.column("a"), b.column("b"), pa.array(far, pa.float64()), pa.array(linked)],
                names=["a", "b", "distance", "linked"])

    def measure(pairs: DataFrame) -> DataFrame:
        # a hub with many members is met by its members in groups of 256
        parts = pairs.groupBy("b").agg(F.ceil(F.count("*") / 256).alias("parts"))
        near = pairs.join(parts, "b").withColumn("part", F.pmod(F.xxhash64("a"), "parts"))
        hubs = (parts.join(content.select(F.col("node").alias("b"), F.col("text").alias("text_b")),
                           "b").withColumn("part", F.explode(F.sequence(
                               F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts"))
        members = near.drop("parts").join(
            content.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        return members.join(hubs, ["b", "part"]).select("a", "b", "text_a", "text_b").mapInArrow(
            compare, "a long, b long, distance double, linked boolean")

    labels = link(marked(busy, marks), measure, percent)
    known = nodes.select("digest", "node", "first_id").join(labels, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    ids = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_set = known.join(ids, "root").select("digest", "component_id")
    return rows_.join(by_set, "digest", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"))
