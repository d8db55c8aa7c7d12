"""Closed syncmers against a plain loop over k-mers, and the order of successors."""

import base64
import hashlib
import random
import re
import struct

import xxhash
from odd import empty, frame, rows
from pyspark.sql import functions as F
from statframe.llm import fingerprints as FP
from statframe.llm.queries import QUERIES

M = (1 << 64) - 1


def chain(values, seed=42):
    """Spark's xxhash64 of several longs, or of one array of them."""
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=seed & M)
        seed -= (seed >> 63) << 64
    return seed


def token_hash(t):
    h = xxhash.xxh64_intdigest(t.encode(), seed=42)
    return h - ((h >> 63) << 64)


def anchors(text):
    h = [token_hash(t) for t in re.findall(r"[^\x20\x09-\x0D]{1,3}", text or "")]
    if not h:
        return []
    if len(h) < FP.K:
        return [(0, chain(h))]
    out = []
    for i in range(len(h) - FP.K + 1):
        kmer = h[i:i + FP.K]
        # the merge of the S-token substrings: two, then the third
        inner = [chain([chain(kmer[j:j + 2]), kmer[j + 2]]) for j in range(FP.K - FP.S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append((i, chain(kmer)))
    return out


def encoded(a):
    return base64.b64encode(b"".join(struct.pack(">I", h & 0xFFFFFFFF) for _, h in a)).decode()


def alike(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(data):
    """(doc_id, n_chars, edited, anchors, edited anchors, next anchors) in descending doc_id."""
    def h(t):
        return token_hash(t or "")

    order = sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0), h(r[1])))
    out = []
    for (d, t), (_, u) in zip(order, order[1:] + order[:1]):
        t, u = t or "", u or ""
        cut = len(t) // 3
        e = t[:len(t) - cut] + u[:cut]
        out.append((d, len(t), e, anchors(t), anchors(e), anchors(u)))
    return out


def found(df):
    return [(r["doc_id"], r["n_chars"], r["edited"], *[[tuple(x) for x in r[c]] for c in (
        "anchors", "edited_anchors", "next_anchors")]) for r in df.collect()]


def key(r):
    return str(r)


def test_every_document(spark, monkeypatch):
    """Many ranges, so that successors cross their bounds."""
    monkeypatch.setattr(FP, "RANGE_ROWS", 8)
    rng = random.Random(2)
    words = [f"w{i}é" * rng.choice([1, 2]) for i in range(80)]
    data = [(i * 7 - 500, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 2, 8, 40, 200]))))
            for i in range(300)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(6)
    got = found(FP.with_next(docs))
    assert sorted(got, key=key) == sorted(brute(data), key=key)


def test_odd_rows(spark, monkeypatch):
    """Null ids and texts, repeated ids and rows, long texts, clashing columns."""
    data = [r[:2] for r in rows()]
    want = sorted(brute(data), key=key)
    assert sorted(found(FP.with_next(frame(spark))), key=key) == want
    monkeypatch.setattr(FP, "RANGE_ROWS", 5)
    assert sorted(found(FP.with_next(frame(spark))), key=key) == want


def test_few_rows(spark):
    assert FP.with_next(empty(spark)).collect() == []
    assert FP.fingerprints(empty(spark)).collect() == []
    one = [(3, "one two three four five six seven eight nine ten")]
    assert found(FP.with_next(spark.createDataFrame(one, "doc_id long, text string"))) == brute(one)
    none = [(None, "some text here"), (None, "another text")]
    got = found(FP.with_next(spark.createDataFrame(none, "doc_id long, text string")))
    assert sorted(got, key=key) == sorted(brute(none), key=key)


def test_encoding_and_matches(spark):
    text = " ".join(f"word{i} of{i * 7 % 31}" for i in range(120))
    data = [(1, text), (2, "before it " + text + " after")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {r["doc_id"]: r for r in FP.fingerprints(df).collect()}
    for d, t in data:
        assert got[d]["fingerprint"] == encoded(anchors(t))
    a, b = (FP.with_anchors(df.filter(f"doc_id = {d}"), "text", f"a{d}") for d in (1, 2))
    m = a.crossJoin(b.select("a2")).select(FP.matched(F.col("a1"), F.col("a2")).alias("m")).first()["m"]
    # every anchor of the inner text is found again, three tokens further on
    assert len(m) == len(anchors(text)) and {y - x for x, y in m} == {3}


def test_every_window_has_an_anchor():
    rng = random.Random(4)
    for _ in range(50):
        pos = [p for p, _ in anchors(" ".join(str(rng.random()) for _ in range(60)))]
        assert all(b - a <= FP.K - FP.S + 1 for a, b in zip(pos, pos[1:]))


def test_query(spark, tmp_path):
    rng = random.Random(9)
    data = [(i, " ".join(rng.choice("ab cd efg hijk lmnop qrs".split()) for _ in range(60 * (i % 4))))
            for i in range(80)]
    data += [(200 + i, data[i][1]) for i in range(40)]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in QUERIES["op11_fingerprints"](spark, str(tmp_path)).collect()}
    assert len(got) == len(data)
    for d, n, e, a, ea, na in brute(data):
        r = got[d]
        assert (r["n_chars"], r["edited_sha256"]) == (n, hashlib.sha256(e.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (encoded(a), encoded(ea))
        assert (r["near_edited"], r["near_next"]) == (alike(a, ea), alike(a, na))


def test_edited_text_is_nearer_than_the_next(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = QUERIES["op11_fingerprints"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == docs.count()
    long = [r for r in got if r["n_chars"] >= 300]
    assert sum(r["near_edited"] > r["near_next"] for r in long) >= 0.95 * len(long)
    assert sum(r["near_edited"] for r in long) / len(long) > 0.4
