"""Hidden Markov language model with exact sequence likelihoods (operator 3).

Words are lower-cased; every text ends with one end token.  The training documents' word
counts are gathered in full.  The model emits classes: each of the ``top`` most
frequent words is a class of its own, the end token is one, and all other words fall into
``SUFFIX_CLASSES`` classes by their last bytes; within such a class a word has probability
(c + 1) / (T + D + 1), with its count c, the class's tokens T and distinct words D, and one
share for all unseen words.  The latent states are trained by Baum-Welch: every iteration
runs over all training documents, each task sums its expected counts, and only these sums
(states x classes) meet.  A text's probability is the product of the scaled forward
recursion's sums, exact for the whole text.

Long texts are cut into segments of SEGMENT tokens.  A segment's transfer matrix carries the
forward vector across it, so that all segments advance together and memory does not grow with
the longest text.

Counts of rare words never sit in one place: documents are grouped into blocks of a fixed
volume, a block asks for each of its distinct words once (joined by word), and the answers go
back to the block.  Top words and class totals are the only tables that every task holds; their
size is a parameter.

Null text: empty, the end token alone.  Null doc_id: its text form is empty for the
train/held-out split.  Repeated doc_ids: scored row by row, all of them used.  Empty training
set: every word unknown, base 0 in log10.  Empty input: empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statframe.llm.common import id_text, stored, text_groups

#: the end token's key; no word contains a space
END = b" "
SUFFIX_CLASSES = 256
SEGMENT = 1024
#: text bytes and documents of a block
BLOCK_BYTES, BLOCK_DOCS = 8 << 20, 1 << 15
#: text bytes whose words are counted together
COUNT_BYTES = 16 << 20
#: steps after which transfer matrices are scaled: as small as emissions are, so many don't underflow
SCALED = 8
#: tokens that run through the recursions together
GROUP_TOKENS = 1 << 20


def suffix_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % SUFFIX_CLASSES


def _numbered(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(words, code, ends): the distinct lower-cased words of a column of texts, the number of each word of
    all texts, one after another, and where each text's words end."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string())))
    coded, ends = split.flatten().dictionary_encode(), split.offsets.to_numpy()[1:].astype(np.int64)
    at = np.frombuffer(coded.dictionary.buffers()[1], np.int32, len(coded.dictionary) + 1).tolist() \
        if len(coded) else [0]
    data = coded.dictionary.buffers()[2].to_pybytes() if at[-1] else b""
    words, code = [data[i:j] for i, j in zip(at, at[1:])], coded.indices.to_numpy().astype(np.int64)
    if b"" in words:  # beside white space at a text's ends
        some = code != words.index(b"")
        code, ends = code[some], np.append(0, np.cumsum(some))[ends]
    return words, code, ends


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, cls, n): the documents' tokens, the end token among them."""

    def run(batches):
        def out(held):
            words, code, _ = _numbered(pa.concat_arrays(held))
            n = np.append(np.bincount(code, minlength=len(words)), sum(map(len, held)))
            return pa.RecordBatch.from_arrays(
                [pa.array([*words, END], pa.binary()),
                 pa.array([*map(suffix_class, words), -1], pa.int32()), pa.array(n, pa.int64())],
                names=["word", "cls", "n"])

        held, size = [], 0
        for b in text_groups(batches, COUNT_BYTES):
            held.append(b.column("text"))
            size += held[-1].nbytes
            if size >= COUNT_BYTES:
                yield out(held)
                held, size = [], 0
        if held:
            yield out(held)

    return docs.select("text").mapInArrow(run, "word binary, cls int, n long").groupBy(
        "word", "cls").agg(F.sum("n").alias("n")).filter("n > 0")


@dataclass
class Vocabulary:
    """What every task holds of the counts: top words, class totals, overall totals."""

    top: dict[bytes, int]      # word -> class
    top_counts: np.ndarray     # by class of a top word
    tokens: np.ndarray         # of each suffix class, without top words
    types: np.ndarray
    n_end: int
    n_tokens: int
    n_types: int

    @property
    def n_classes(self) -> int:
        return len(self.top) + SUFFIX_CLASSES + 1

    @property
    def end(self) -> int:
        return self.n_classes - 1

    def unigram(self) -> np.ndarray:
        n = np.concatenate([self.top_counts, self.tokens, [self.n_end]]) + 1.0
        return n / n.sum()


def vocabulary(counts: DataFrame, top: int) -> Vocabulary:
    words = counts.filter(F.col("cls") >= 0)
    best = words.orderBy(F.desc("n"), "word").limit(top).collect()
    by_class = {r.cls: r for r in counts.groupBy("cls").agg(
        F.sum("n").alias("t"), F.count("*").alias("d")).collect()}
    end = by_class.pop(-1, None)
    tokens, types = np.zeros(SUFFIX_CLASSES), np.zeros(SUFFIX_CLASSES)
    for c, r in by_class.items():
        tokens[c], types[c] = r.t, r.d
    n_end = int(end.t) if end else 0
    n_tokens, n_types = int(tokens.sum()) + n_end, int(types.sum()) + bool(n_end)
    for r in best:
        tokens[r.cls] -= r.n
        types[r.cls] -= 1
    return Vocabulary({bytes(r.word): k for k, r in enumerate(best)},
                      np.array([r.n for r in best], np.float64), tokens, types, n_end, n_tokens,
                      n_types)


CODED = ("kind int, block long, idx int, doc_id long, held_out boolean, n_tokens long, "
         "n_known long, base double, fixed double, seq binary, word binary, posts binary")
_CODED_TYPES = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(),
                pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.binary()]
_NAMES = [f.split()[0] for f in CODED.split(", ")]


def _packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Consecutive runs of ``values`` as one binary value each."""
    off = (np.concatenate([[0], ends]) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends),
                                 [None, pa.py_buffer(off), pa.py_buffer(values.tobytes())])


def encode(rows: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Kind 0: a document with its class sequence and what is known of its score without rare
    words.  Kind 1: a rare word of a block, and its postings: the number of a
    document in the block and how often it holds the word."""
    n_top = len(vocab.top)
    log_share = np.log10(vocab.tokens + vocab.types + 1)
    log_all = np.log10(vocab.n_tokens + vocab.n_types + 1)
    log_top = np.log10(vocab.top_counts + 1)
    log_end = np.log10(vocab.n_end + 1)

    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 31
        local: dict[bytes, int] = defaultdict()
        local.default_factory = local.__len__
        docs, at, who, held_bytes = [], [], [], 0

        def out():
            nonlocal held_bytes, block
            crc32 = zlib.crc32
            cls = np.array([crc32(w[-3:]) for w in local], np.int64) % SUFFIX_CLASSES
            cols = [[] for _ in range(10)]
            for k, (doc, held, seq, rare) in enumerate(docs):
                own = cls[rare]
                known_top = seq[seq < n_top]
                seq[seq == n_top] = n_top + own  # places of rare words, in order
                n = len(seq)
                base = log_top[known_top].sum() + log_end - n * log_all
                for c, v in zip(cols, (0, block, k, doc, held, n,
                                       len(known_top) + (vocab.n_end > 0), float(base),
                                       -float(log_share[own].sum()),
                                       seq.astype("<u2").tobytes())):
                    c.append(v)
            n = len(docs)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, t) for c, t in zip(cols, _CODED_TYPES)),
                 *(pa.nulls(n, pa.binary()) for _ in range(2))], names=_NAMES)
            if local:
                pair, times = np.unique(
                    np.concatenate(at).astype(np.int64) << 32 | np.concatenate(who),
                    return_counts=True)
                # a posting has 16 bits for the count; a larger one becomes several postings
                parts = -(-times // 0xFFFF)
                left = np.repeat(times, parts) - 0xFFFF * (
                    np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
                pair = np.repeat(pair, parts)
                posts = (pair & 0xFFFF) << 16 | np.minimum(left, 0xFFFF)
                ends = np.searchsorted(pair >> 32, np.arange(len(local)), side="right")
                n = len(local)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(n, np.int32)), pa.array(np.full(n, block)),
                     *(pa.nulls(n, t) for t in _CODED_TYPES[2:10]),
                     pa.array(list(local), pa.binary()), _packed(posts.astype("<u4"), ends)],
                    names=_NAMES)
            local.clear()
            docs.clear()
            at.clear()
            who.clear()
            held_bytes = 0
            block += 1

        get = vocab.top.get
        parts = (b.slice(i, BLOCK_DOCS) for b in text_groups(batches, BLOCK_BYTES // 2)
                 for i in range(0, b.num_rows, BLOCK_DOCS))
        for b in parts:
            # a posting has 16 bits for the document
            if docs and len(docs) + b.num_rows > BLOCK_DOCS:
                yield from out()
            words, code, ends = _numbered(b.column("text"))
            known = np.fromiter(map(get, words, repeat(n_top)), np.int64, len(words))
            met = np.zeros(len(words), bool)
            met[code] = True
            own = np.flatnonzero((known == n_top) & met)
            number = np.zeros(len(words), np.int64)
            number[own] = [local[words[i]] for i in own.tolist()]
            every, number, lo = known[code], number[code], 0
            for doc, held, hi in zip(b.column("doc_id").to_pylist(), b.column("held_out").to_pylist(),
                                     ends.tolist()):
                seq = np.append(every[lo:hi], vocab.end)
                rare = number[lo:hi][seq[:-1] == n_top]
                at.append(rare)
                who.append(np.full(len(rare), len(docs), np.int64))
                docs.append((doc, held, seq, rare))
                lo = hi
            held_bytes += b.column("text").nbytes
            if held_bytes >= BLOCK_BYTES or len(docs) >= BLOCK_DOCS:
                yield from out()
        if docs:
            yield from out()

    return rows.select("doc_id", "held_out", "text").mapInArrow(run, CODED)


class Model:
    """Start, transition and emission probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit
        #: a class's emissions side by side, as the recursions read them
        self.by_class = np.ascontiguousarray(emit.T)

    @classmethod
    def initial(cls, unigram: np.ndarray, states: int, seed: int) -> Model:
        rng = np.random.default_rng(seed)
        emit = unigram * rng.gamma(1.0, 1.0, (states, len(unigram)))
        move = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(1, keepdims=True))


class _Group:
    """Segments of some sequences, longest first and time-major, so that each step of a
    recursion is one array operation over the segments that are still running."""

    def __init__(self, seqs: list[np.ndarray]):
        part = [(d, k, s[k:k + SEGMENT]) for d, s in enumerate(seqs)
                for k in range(0, len(s), SEGMENT)]
        part.sort(key=lambda p: -len(p[2]))
        self.doc = np.array([p[0] for p in part])
        self.order = np.array([p[1] // SEGMENT for p in part])
        length = np.array([len(p[2]) for p in part])
        self.running = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")
        self.begin = np.concatenate([[0], np.cumsum(self.running)])
        self.obs = np.empty(self.begin[-1], np.int64)
        for k, (_, _, s) in enumerate(part):
            self.obs[self.begin[:len(s)] + k] = s
        self.n_docs, self.n = len(seqs), len(part)
        #: number of the segment by (document, order)
        self.number = {(d, o): k for k, (d, o) in enumerate(zip(self.doc.tolist(),
                                                                self.order.tolist()))}
        self.segments = np.bincount(self.doc, minlength=self.n_docs)

    def transfers(self, m: Model) -> dict[int, np.ndarray]:
        """Transfer matrix of every segment behind a first one, scaled to a sum of 1."""
        rows = np.flatnonzero(self.order)
        k = len(m.start)
        # a row of all matrices lies together: each step is a few operations on long arrays
        t = np.repeat(np.eye(k)[:, None], len(rows), axis=1)
        emit, moved = m.by_class, np.empty_like(t)
        for step, (n, live) in enumerate(zip(self.running, np.searchsorted(rows, self.running).tolist())):
            if not live:
                break
            e = emit.take(self.obs[self.begin[step] + rows[:live]], axis=0)
            np.matmul(t[:, :live], m.move, out=moved[:, :live])
            np.multiply(moved[:, :live], e, out=t[:, :live])
            if step % SCALED == SCALED - 1:
                t[:, :live] /= t[:, :live].sum(axis=(0, 2))[:, None]
        t /= t.sum(axis=(0, 2))[:, None]
        return dict(zip(rows.tolist(), np.ascontiguousarray(t.transpose(1, 0, 2))))

    def forward(self, m: Model, first: np.ndarray, keep: bool = False):
        """(log likelihoods, last vectors, all vectors, all scales) of the segments from the given
        vectors before the first emission."""
        emit, ones = m.by_class, np.ones(first.shape[1])
        log, last = np.zeros(self.n), np.empty_like(first)
        alpha = np.empty((len(self.obs), first.shape[1])) if keep else None
        scale = np.empty(len(self.obs)) if keep else None
        a = first
        for step, n in enumerate(self.running):
            lo = self.begin[step]
            a = (a[:n] if step == 0 else a[:n] @ m.move) * emit.take(self.obs[lo:lo + n], axis=0)
            c = a @ ones
            a /= c[:, None]
            log[:n] += np.log(c)
            last[:n] = a
            if keep:
                alpha[lo:lo + n], scale[lo:lo + n] = a, c
        return log, last, alpha, scale

    def entries(self, m: Model):
        """Vectors before each segment's first emission and backward vectors at each segment's
        end.  Only documents of several segments take work: the transfer matrices of their
        later segments, and a forward pass over their first ones."""
        k = len(m.start)
        first, back = np.tile(m.start, (self.n, 1)), np.ones((self.n, k))
        long = np.flatnonzero(self.segments > 1).tolist()
        if not long:
            return first, back
        t = self.transfers(m)
        opening = [self.number[d, 0] for d in long]
        # first segments of long documents are full: the rows are the same at every step
        emit, a = m.by_class, np.tile(m.start, (len(long), 1))
        for step in range(SEGMENT):
            a = (a if step == 0 else a @ m.move) * emit[self.obs[self.begin[step] + opening]]
            a /= a.sum(axis=1, keepdims=True)
        for d, a in zip(long, a):
            own = [self.number[d, o] for o in range(self.segments[d])]
            for s in own[1:]:
                first[s] = a @ m.move
                a = a @ t[s]
                a = a / a.sum()
            for s, after in zip(own[-2::-1], own[:0:-1]):
                b = t[after] @ back[after]
                back[s] = b / b.sum()
        return first, back

    def likelihoods(self, m: Model) -> np.ndarray:
        """Every document's log likelihood: its segments' sums of log scales."""
        log = self.forward(m, self.entries(m)[0])[0]
        return np.bincount(self.doc, log, self.n_docs)

    def expected(self, m: Model):
        """Expected counts (start, move, emit) and the log likelihood, summed over documents."""
        first, back = self.entries(m)
        log, last, alpha, scale = self.forward(m, first, keep=True)
        # forward and backward vectors of a place multiply to 1
        back /= (last * back).sum(axis=1, keepdims=True)
        k, emit = len(m.start), m.by_class
        move, counts, b = np.zeros((k, k)), np.empty_like(alpha), None
        for step in range(len(self.running) - 1, -1, -1):
            n, lo = self.running[step], self.begin[step]
            if b is None:
                b = back[:n]
            else:
                nxt, at = self.running[step + 1], self.begin[step + 1]
                v = emit.take(self.obs[at:at + nxt], axis=0)
                v *= b
                v /= scale[at:at + nxt, None]
                move += alpha[lo:lo + nxt].T @ v
                b = np.concatenate([v @ m.move.T, back[nxt:n]])
            # their products sum to 1 at every place, as they do at the segments' ends
            np.multiply(alpha[lo:lo + n], b, out=counts[lo:lo + n])
        move *= m.move
        # moves over the seams between segments
        seams = [(self.number[d, o], self.number[d, o + 1])
                 for d in np.flatnonzero(self.segments > 1).tolist()
                 for o in range(self.segments[d] - 1)]
        if seams:
            s, after = np.array(seams).T
            x = last[s][:, :, None] * m.move * (emit[self.obs[after]] * b[after])[:, None, :]
            move += (x / x.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        start = counts[:self.n][self.order == 0].sum(axis=0)
        at = (self.obs[:, None] * k + np.arange(k)).ravel()
        by_class = np.ascontiguousarray(np.bincount(
            at, counts.ravel(), m.emit.shape[1] * k).reshape(-1, k).T)
        return start, move, by_class, log.sum()


def _groups(batches):
    """Record batches regrouped to about GROUP_TOKENS tokens, with the sequences."""
    for b in text_groups(batches, 2 * GROUP_TOKENS, "seq"):
        yield b, _Group([np.frombuffer(s, "<u2").astype(np.int64)
                         for s in b.column("seq").to_pylist()])


def baum_welch(coded: DataFrame, model: Model, unigram: np.ndarray, iterations: int) -> Model:
    """Train on all documents of ``coded`` that are not held out."""
    train = coded.filter("kind = 0 and not held_out").select("seq")
    k, s = model.emit.shape
    for _ in range(iterations):
        def run(batches, model=model):
            total = np.zeros(k + k * k + k * s)
            for _, g in _groups(batches):
                start, move, emit, _ = g.expected(model)
                total += np.concatenate([start, move.ravel(), emit.ravel()])
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])],
                                             names=["at", "value"])

        # one row per parameter of the model comes back
        got = train.mapInArrow(run, "at int, value double").groupBy("at").agg(
            F.sum("value").alias("value")).collect()
        if not got:
            return model
        total = np.zeros(k + k * k + k * s)
        total[[r["at"] for r in got]] = [r["value"] for r in got]
        start, move = total[:k] + 0.1, total[k:k + k * k].reshape(k, k) + 0.1
        emit = total[k + k * k:].reshape(k, s) + unigram
        model = Model(start / start.sum(), move / move.sum(1, keepdims=True),
                      emit / emit.sum(1, keepdims=True))
    return model


def _answers(coded: DataFrame, counts: DataFrame) -> DataFrame:
    """(block, idx, rare_log, rare_known): each document's sum of log10(c + 1) over its rare
    tokens, and how many of them are known."""

    def settle(t: pa.Table) -> pa.Table:
        n = t.column("n").to_numpy()
        posts = t.column("posts").to_pylist()
        size = [len(p) // 4 for p in posts]
        posts = np.frombuffer(b"".join(posts), "<u4")
        who, times = (posts >> 16).astype(np.int64), (posts & 0xFFFF).astype(np.float64)
        value, known = np.repeat(np.log10(n + 1.0), size), np.repeat(n > 0, size)
        at = np.unique(who)
        return pa.table({
            "block": pa.array(np.full(len(at), t.column("block")[0].as_py())),
            "idx": pa.array(at.astype(np.int32)),
            "rare_log": pa.array(np.bincount(who, times * value)[at]),
            "rare_known": pa.array(np.bincount(who, times * known)[at].astype(np.int64))})

    words = coded.filter("kind = 1").select("block", "word", "posts")
    return (words.join(counts.filter("cls >= 0").select("word", "n"), "word", "left")
            .select("block", F.coalesce("n", F.lit(0)).alias("n"), "posts")
            .groupBy("block").applyInArrow(
                settle, "block long, idx int, rare_log double, rare_known long"))


def score(docs: DataFrame, held_out: str, states: int = 8, iterations: int = 5,
          top: int = 4096, seed: int = 7, id_col: str = "doc_id", text_col: str = "text"
          ) -> DataFrame:
    """Train on the rows of ``docs`` where ``held_out`` (SQL over ``doc_id``) is false
    and score all rows: (doc_id, held_out, n_tokens, n_known, train_tokens, base, score), base
    and score in log10; base is the add-one unigram's."""
    rows = id_text(docs, id_col, text_col).withColumn("held_out", F.expr(held_out))
    counts = stored(word_counts(rows.filter(~F.col("held_out"))), "counts")
    vocab = vocabulary(counts, top)
    coded = stored(encode(rows, vocab), "coded")
    unigram = vocab.unigram()
    model = baum_welch(coded, Model.initial(unigram, states, seed), unigram, iterations)

    def run(batches):
        for b, g in _groups(batches):
            total = g.likelihoods(model) / np.log(10)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(total)], names=[*b.schema.names[:-1], "hmm"])

    cols = ["block", "idx", "doc_id", "held_out", "n_tokens", "n_known", "base", "fixed"]
    scored = coded.filter("kind = 0").select(*cols, "seq").mapInArrow(
        run, "block long, idx int, doc_id long, held_out boolean, n_tokens long, n_known long, "
        "base double, fixed double, hmm double")
    rare = F.coalesce("rare_log", F.lit(0.0))
    return scored.join(_answers(coded, counts), ["block", "idx"], "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + rare).alias("base"),
        (F.col("hmm") + F.col("fixed") + rare).alias("score"))
