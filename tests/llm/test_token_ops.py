"""Token counts, id files and packing against the tokenizers library."""

import glob
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from odd import empty, frame, rows
from pyspark.sql import functions as F

from statframe.llm import id_files, packing, token_counts
from statframe.llm.token_cache import IdCache
from statframe.session import scratch_path

VOCAB = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCAB)


def ids_of(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("chunk", [40, 1 << 16])
def test_counts_match_library(spark, tok, chunk):
    """Also with chunks far smaller than the words of the texts."""
    got = token_counts.token_counts(frame(spark), VOCAB, chunk_chars=chunk).collect()
    want = Counter((r[0], len((r[1] or "").encode()), len(ids_of(tok, r[1]))) for r in rows())
    assert Counter(map(tuple, got)) == want


def test_transducer_shares_states(tok):
    fst = token_counts.Transducer(VOCAB)
    assert fst.count(b"a" * 4000) == len(ids_of(tok, "a" * 4000))
    assert len(fst.states) < 400  # a run of one letter needs no state per letter
    fst.most_states = 10
    assert [fst.count(w) for w in (b" the", b"straight", b"oneself")] == [
        len(ids_of(tok, w)) for w in (" the", "straight", "oneself")]


def test_counts_of_columns_match_library(tok):
    """Words, white space and special strings in any order, with a small memory too; a transition that many
    new words take is looked up once."""
    rng = np.random.default_rng(11)
    parts = ["a", "Be", "é", "\n", " ", "\t", "\x0b", "\x85", "\xa0", "\x1c", ".", "'s", "1", "中",
             "<|endoftext|>", "\r", "\u3000", "\u200b", "\u0301", "ll", "!", "\U0001F600"]
    texts = [r[1] or "" for r in rows()] + [
        "".join(rng.choice(parts, rng.integers(0, 14))) for _ in range(2000)]
    want = [len(ids_of(tok, t)) for t in texts]
    c = token_counts.Counter(VOCAB)
    assert c.column(pa.array(texts)).tolist() == c.whole(texts) == want
    assert c.column(pa.array([], pa.string())).tolist() == []
    c.cache.most, c.fst.most_states = 300, 50
    got = [c.column(pa.array(texts[i:i + 40])).tolist() for i in range(0, len(texts), 40)]
    assert sum(got, []) == want

    class Looked(dict):
        n = 0

        def get(self, key):
            Looked.n += 1
            return super().get(key)

    c = token_counts.Counter(VOCAB)
    c.fst.step = Looked(c.fst.step)
    text = " ".join(f"word{i}x" for i in range(1000))
    assert c.column(pa.array([text])).tolist() == [len(ids_of(tok, text))]
    assert Looked.n < 2000


def test_maps_compose_associatively():
    c = token_counts.counter(VOCAB)
    text = " ".join(r[1] or "" for r in rows())
    maps = [c.state_map(text[i:i + 97]) for i in range(0, len(text), 97)]
    k = len(maps) // 3
    left = c.compose([c.compose(maps[:k]), *maps[k:]])
    assert left == c.compose([*maps[:k], c.compose(maps[k:])]) == c.compose(maps)


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 3000])
def test_elias_fano_round_trip(n):
    rng = np.random.default_rng(n)
    for top in (1, n + 1, 1 << 40):
        v = np.sort(rng.integers(0, top, n)).astype(np.uint64)
        code = id_files.EliasFano.encode(v)
        ef = id_files.EliasFano(code)
        assert ef.all().tolist() == v.tolist()
        assert [ef.select(i) for i in range(n)] == v.tolist()
        if n >= 256:
            assert len(code) * 8 <= n * (2 + np.log2(max(2, 2 * top / n)) + 1) + 400


def test_elias_fano_checks_index():
    with pytest.raises(IndexError):
        id_files.EliasFano(id_files.EliasFano.encode(np.array([3]))).select(1)


def test_id_files_round_trip(spark, tok):
    path = scratch_path(spark, "ids")
    id_files.write_id_files(frame(spark), path, VOCAB, end_id=2, block_ids=500)
    got = id_files.read_id_files(spark, path).orderBy("start").collect()
    ids = [np.frombuffer(r.ids, "<u4").tolist() for r in got]
    assert [r.doc_id for r in got] == sorted(
        (r[0] for r in rows()), key=lambda d: (d is not None, d or 0))
    assert [r.start for r in got] == np.cumsum([0, *map(len, ids)])[:-1].tolist()
    assert all(r.n_tokens == len(x) for r, x in zip(got, ids))
    want = Counter((r[0], tuple(ids_of(tok, r[1])) + (2,)) for r in rows())
    assert Counter((r.doc_id, tuple(x)) for r, x in zip(got, ids)) == want


def test_documents_are_encoded_by_one_worker_a_task(spark, monkeypatch):
    """Ids get their width where they are made: a second Python step would be a second worker."""
    plans, store = [], id_files.stored
    monkeypatch.setattr(id_files, "stored", lambda df, name: plans.append(
        df._jdf.queryExecution().optimizedPlan().toString()) or store(df, name))
    id_files.write_id_files(frame(spark), scratch_path(spark, "ids"), VOCAB, end_id=2)
    assert [p.count("MapInArrow") for p in plans] == [1]


def test_id_files_of_nothing(spark):
    path = scratch_path(spark, "ids")
    id_files.write_id_files(empty(spark), path, VOCAB, end_id=2)
    assert id_files.read_id_files(spark, path).count() == 0
    assert token_counts.token_counts(empty(spark), VOCAB).count() == 0
    assert packing.pack(empty(spark), VOCAB, 0).count() == 0


@pytest.mark.parametrize("capacity,batch", [(1024, 2048), (64, 7)])
def test_packing_is_lossless_and_tight(spark, tok, capacity, batch):
    got = packing.pack(frame(spark), VOCAB, 0, capacity=capacity, piece=min(256, capacity),
                       batch_docs=batch).withColumn("crc", F.crc32("ids")).collect()
    by_sequence = defaultdict(list)
    texts = defaultdict(list)
    for r in got:
        assert len(r.ids) == 4 * r.length and r.crc == zlib.crc32(r.ids)
        by_sequence[r.sequence_id].append((r.offset, r.length))
        texts[r.doc_id, r.doc_tokens].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    unique = [r for r in rows() if r[0] and r[0] >= 100]
    for d, t, *_ in unique:
        want = ids_of(tok, t) + [0]
        parts = sorted(texts[d, len(want)])
        assert [i for _, x in parts for i in x] == want
    total = sum(r.length for r in got)
    assert total == sum(len(ids_of(tok, r[1])) + 1 for r in rows())
    # near-equal windows: little padding once a batch fills several windows
    if capacity == 1024:
        assert len(by_sequence) <= -(-total // capacity) + 3 * 3


def test_differencing_rises_when_full():
    sizes = [6, 6, 6]  # two windows of 9 would do for the total, but no two sizes fit together
    window = packing.near_equal(sizes, 9)
    assert len(set(window.tolist())) == 3
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 257, 3000).tolist()
    fill = np.bincount(packing.near_equal(sizes, 1024), sizes)
    assert fill.max() <= 1024 and fill.min() > 1000 and fill.sum() == sum(sizes)


def test_ids_of_columns_match_library(tok):
    """Words and white space in any order, a small memory, and each new word encoded once only."""
    rng = np.random.default_rng(7)
    parts = ["a", "Be", "é", "\n", " ", "\t", "\x0b", "\x85", "\xa0", "\x1c", ".", "'s", "1", "中",
             "<|endoftext|>", "\r", "　", "​", "́", "ll", "!", "\U0001F600"]
    texts = [r[1] or "" for r in rows()] + [
        "".join(rng.choice(parts, rng.integers(0, 14))) for _ in range(2000)]
    for most, step in ((500_000, len(texts)), (300, 40)):
        cache = IdCache(tok, most)
        for i in range(0, len(texts), step):
            some = texts[i:i + step]
            ids, ends = cache.batch(pa.array(some), 2)
            assert [x.tolist() for x in np.split(ids, ends[:-1])] == [ids_of(tok, t) + [2] for t in some]
    ids, ends = cache.batch(pa.array([], pa.string()))
    assert len(ids) == len(ends) == 0


def test_new_words_are_encoded_together(tok):
    seen = []

    class Counting:
        encode = tok.encode

        def encode_batch_fast(self, texts, **how):
            seen.extend(texts)
            return tok.encode_batch_fast(texts, **how)

    cache = IdCache(Counting())
    text = pa.array(["one " + " ".join(f"word{i}x" for i in range(1000))] * 3)
    ids, ends = cache.batch(text)
    assert np.diff(ends, prepend=0).tolist() == [len(ids_of(tok, text[0].as_py()))] * 3
    assert len(seen) <= 12
    cache.batch(text)
    assert len(seen) <= 12


def test_ids_lie_on_disk_as_zstd(spark, monkeypatch):
    """Stored ids and id files; the stored ones go when the files are written."""
    coded, store = [], id_files.stored
    codec = []

    def codecs(path):
        return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression
                for f in glob.glob(f"{path.removeprefix('file:')}/*.parquet")}

    def seen(df, name):
        coded.append(store(df, name))
        codec.append(codecs(coded[-1].stored_at))
        return coded[-1]

    monkeypatch.setattr(id_files, "stored", seen)
    path = scratch_path(spark, "ids")
    id_files.write_id_files(frame(spark), path, VOCAB, end_id=2)
    assert codec == [{"ZSTD"}] and codecs(path) == {"ZSTD"}
    assert not glob.glob(f"{coded[0].stored_at.removeprefix('file:')}/*")


def test_differencing_matches_plain_merging():
    """The same windows as with all k sums in every node, one merge after the other."""
    import heapq

    def plain(sizes, k):
        heap = []
        for i, s in enumerate(sizes):
            sums = np.zeros(k, np.int64)
            sums[-1] = s
            heap.append((-s if k > 1 else 0, i, sums, [[] for _ in range(k - 1)] + [[i]]))
        heapq.heapify(heap)
        at = len(sizes)
        while len(heap) > 1:
            _, _, x, of_x = heapq.heappop(heap)
            _, _, y, of_y = heapq.heappop(heap)
            sums, own = x + y[::-1], [p + q for p, q in zip(of_x, of_y[::-1])]
            order = np.argsort(sums, kind="stable")
            sums = sums[order]
            heapq.heappush(heap, (int(sums[0] - sums[-1]), at, sums, [own[j] for j in order]))
            at += 1
        window = np.zeros(len(sizes), np.int64)
        for w, members in enumerate(heap[0][3]):
            window[members] = w
        return window

    rng = np.random.default_rng(1)
    for _ in range(300):
        k, top = int(rng.integers(1, 20)), int(rng.integers(2, 257))
        sizes = rng.integers(1, top, int(rng.integers(1, 60))).tolist()
        assert (packing.difference(sizes, k) == plain(sizes, k)).all()


def test_differencing_takes_chains_in_one_step(monkeypatch):
    merges, push = [], packing.heapq.heappush
    monkeypatch.setattr(packing.heapq, "heappush", lambda h, x: (merges.append(1), push(h, x)))
    packing.difference(list(range(1, 901)), 100)
    assert len(merges) < 100
