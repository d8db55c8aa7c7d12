"""The language model against plain recursions over one document at a time."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from odd import empty, frame, rows
from pyspark.sql import functions as F

from statframe.llm import hmm_lm as L
from statframe.llm.common import space_words

HELD = "crc32(cast(coalesce(cast(doc_id AS string), '') AS binary)) % 7 = 2"


def is_held(d):
    return zlib.crc32(str("" if d is None else d).encode()) % 7 == 2


@pytest.fixture(scope="module")
def toy():
    rng = np.random.default_rng(1)
    emit, move = rng.dirichlet(np.ones(11), 3), rng.dirichlet(np.ones(3), 3)
    m = L.Model(rng.dirichlet(np.ones(3)), move, emit)
    return m, [rng.integers(0, 11, n) for n in (1, 2, 7, 8, 9, 40, 65, 3, 16)]


def brute(m, seq):
    """Likelihood and expected counts of one sequence, without scaling."""
    k, n = len(m.start), len(seq)
    a, b = np.zeros((n, k)), np.ones((n, k))
    a[0] = m.start * m.emit[:, seq[0]]
    for t in range(1, n):
        a[t] = (a[t - 1] @ m.move) * m.emit[:, seq[t]]
    for t in range(n - 2, -1, -1):
        b[t] = m.move @ (m.emit[:, seq[t + 1]] * b[t + 1])
    p = a[-1].sum()
    g = a * b / p
    move = sum((np.outer(a[t], m.emit[:, seq[t + 1]] * b[t + 1]) * m.move / p
                for t in range(n - 1)), np.zeros((k, k)))
    emit = np.zeros_like(m.emit)
    for t in range(n):
        emit[:, seq[t]] += g[t]
    return math.log(p), g[0], move, emit


@pytest.mark.parametrize("segment", [1024, 8, 3, 1])
def test_recursions_with_any_segment(monkeypatch, toy, segment):
    monkeypatch.setattr(L, "SEGMENT", segment)
    m, seqs = toy
    g = L._Group(seqs)
    each = [brute(m, s) for s in seqs]
    assert np.allclose(g.likelihoods(m), [e[0] for e in each])
    start, move, emit, total = g.expected(m)
    assert np.allclose(start, sum(e[1] for e in each))
    assert np.allclose(move, sum(e[2] for e in each))
    assert np.allclose(emit, sum(e[3] for e in each))
    assert np.isclose(total, sum(e[0] for e in each))


def test_long_sequences_do_not_underflow(toy):
    m, _ = toy
    seq = np.random.default_rng(2).integers(0, 11, 30_000)
    a, log = m.start * m.emit[:, seq[0]], 0.0
    for t in range(1, len(seq)):
        a = (a @ m.move) * m.emit[:, seq[t]]
        log, a = log + math.log(a.sum()), a / a.sum()
    log += math.log(a.sum())
    assert np.isclose(L._Group([seq, seq[:5]]).likelihoods(m)[0], log)


def test_scores_against_loops(spark):
    docs = rows(60)
    got = L.score(frame(spark, docs), HELD, states=3, iterations=2, top=7).collect()
    train = [space_words(t or "") for d, t, *_ in docs if not is_held(d)]
    c = Counter(w for ws in train for w in [*ws, L.END])
    n, v = sum(c.values()), len(c)
    want = Counter()
    for d, t, *_ in docs:
        ws = [*space_words(t or ""), L.END]
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)
        want[d, is_held(d), len(ws), sum(c[w] > 0 for w in ws), n, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base, 6))
                   for r in got) == want
    assert all(r.score < 0 for r in got)


def test_blocks_do_not_change_scores(spark, monkeypatch):
    """The parts of a score that pass through blocks, with blocks of one and of many documents."""
    docs = frame(spark, rows(40))
    whole = {(r.doc_id, r.n_tokens): (round(r.base, 8), round(r.score, 6)) for r in
             L.score(docs, HELD, states=2, iterations=1, top=5).collect()}
    real = L.encode
    monkeypatch.setattr(L, "encode", lambda r, v: real(r.repartition(17), v))
    assert whole == {(r.doc_id, r.n_tokens): (round(r.base, 8), round(r.score, 6)) for r in
                     L.score(docs, HELD, states=2, iterations=1, top=5).collect()}


def test_model_is_a_distribution(spark):
    """Over class sequences all probabilities sum to 1, and so do the words of a class."""
    rows_ = L.id_text(frame(spark)).select("text")
    counts = L.word_counts(rows_).cache()
    v = L.vocabulary(counts, 5)
    m = L.Model.initial(v.unigram(), 3, 1)
    assert np.allclose(m.emit.sum(1), 1) and np.allclose(m.move.sum(1), 1)
    assert m.emit.shape[1] == v.n_classes
    share = {}
    for r in counts.filter("cls >= 0").collect():
        if bytes(r.word) not in v.top:
            share[r.cls] = share.get(r.cls, 0) + (r.n + 1) / (v.tokens[r.cls] + v.types[r.cls] + 1)
    for cls, p in share.items():  # the rest is the unseen words' share
        assert np.isclose(p + 1 / (v.tokens[cls] + v.types[cls] + 1), 1)


def test_training_raises_the_likelihood(spark):
    words = [["ab", "cd", "ef", "gh"], ["12", "34", "56", "78"]]
    rng = np.random.default_rng(0)
    docs = [(i, " ".join(rng.choice(words[i % 2], 30))) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    score = [L.score(df, HELD, states=2, iterations=k, top=8).filter("held_out").agg(
        F.sum("score"), F.sum("base")).first() for k in (0, 6)]
    assert score[1][0] > score[0][0] and score[1][0] > score[1][1]


def test_no_training_rows_and_no_rows(spark):
    got = L.score(frame(spark), "true", states=2, iterations=2).collect()
    assert len(got) == len(rows()) and all(r.base == 0 and r.n_known == 0 for r in got)
    assert L.score(empty(spark), HELD).count() == 0


def test_a_word_more_often_than_a_posting_counts(spark):
    """No top words, one word 70,000 times: its postings split and add up."""
    df = spark.createDataFrame([(1, "zz " * 70_000 + "a b"), (2, "a zz"), (3, "b")],
                               "doc_id long, text string")
    got = {r.doc_id: r for r in L.score(df, "false", states=2, iterations=1, top=0).collect()}
    c = {"zz": 70_001, "a": 2, "b": 2}
    all_, v = sum(c.values()) + 3, 4
    want = 70_000 * math.log10(70_002) + 2 * math.log10(3) + math.log10(4) \
        - 70_003 * math.log10(all_ + v + 1)
    assert got[1].n_tokens == got[1].n_known == 70_003
    assert got[1].base == pytest.approx(want)


def test_recursions_read_emissions_side_by_side():
    """Each step gathers whole rows: a class's emissions are one piece of memory, never a column."""
    rng = np.random.default_rng(3)
    model = L.Model.initial(rng.random(500) / 250, 8, 1)
    assert model.by_class.flags.c_contiguous and (model.by_class == model.emit.T).all()

    class Watched(L.Model):
        @property
        def emit(self):
            return self._emit

        @emit.setter
        def emit(self, value):
            self._emit = value.view(NoColumns)

    class NoColumns(np.ndarray):
        @property
        def T(self):  # noqa: N802
            raise AssertionError("emissions read by column")

    seqs = [rng.integers(0, 500, n) for n in (1, 30, 1024, 2500)]
    group = L._Group(seqs)
    want = group.expected(model)
    watched = Watched.__new__(Watched)
    watched.start, watched.move, watched.by_class = model.start, model.move, model.by_class
    watched.emit = model.emit
    got = group.expected(watched)
    for x, y in zip(got, want):
        assert np.allclose(x, y, rtol=1e-12)
    assert np.allclose(group.likelihoods(watched), group.likelihoods(model), rtol=1e-12)


def test_words_are_numbered_by_columns():
    """Distinct words are looked up once a column, whatever white space stands around them."""
    rng = np.random.default_rng(5)
    parts = ["a", "B", "É", "\n", " ", "\t", "\x0b", "\x0c", "\r", "\x85", "\xa0", "\x1c", "中", "İ", "Z.", "\x00"]
    texts = [r[1] or "" for r in rows()] + ["".join(rng.choice(parts, rng.integers(0, 12))) for _ in range(2000)]
    for some in (texts, [""], [" "], []):
        words, code, ends = L._numbered(pa.array(some, pa.string()))
        got = [[words[i] for i in c] for c in np.split(code, ends[:-1])] if some else []
        assert got == [space_words(t) for t in some]
        assert len(set(words)) == len(words)


def test_transfers_of_rare_classes_keep_their_size():
    """Matrices go some steps without scaling; with the smallest emissions of a large corpus too."""
    rng = np.random.default_rng(2)
    unigram = np.full(300, 1e-12)
    unigram[0] = 1 - unigram[1:].sum()
    m = L.Model.initial(unigram, 8, 1)
    seqs = [rng.integers(1, 300, n) for n in (1, 1023, 1024, 1025, 1029, 3000)]
    g = L._Group(seqs)
    for s, t in g.transfers(m).items():
        x = np.eye(8)
        at = int(g.order[s]) * L.SEGMENT
        for c in seqs[g.doc[s]][at:at + L.SEGMENT]:
            x = (x @ m.move) * m.emit[:, c]
            x /= x.sum()
        assert np.allclose(t, x, rtol=1e-9, atol=0)
    assert len(g.transfers(m)) == 4
