"""Severity of toxic texts by cumulative-link ordinal regression (operator 7).

Features are sparse: a word's whole form and its first and last 4 to 6
characters, so that inflected forms share what their stem has taught.  Of these,
the ones kept have a signed root of the likelihood-ratio statistic of at least
``least_root`` between toxic and clean labelled documents (``most_features`` at
most); a document's value is log(1 + occurrences).

Grades: 0 for clean documents; toxic ones are split at the median of their number of
marked words (words with a feature of the toxic side) into 1 and 2.  One weight
vector serves all thresholds: P(grade >= j) = sigmoid(w x - t_j) with t_1 < t_2.
The expected severity is the sum of these probabilities.

The model is fitted on a bounded sample of labelled rows: ``sample_toxic`` toxic and
``sample_clean`` clean documents at most, the first by a hash of their doc_id, weighted back
to the labelled shares.  Rows that repeat a labelled doc_id are one row of the sample, the text
with the smallest hash.  Scoring covers every document.

Labels: null doc_id or null label rows are ignored; a doc_id with several labels is toxic
if one says so.  Without labelled rows of both kinds there is nothing to learn and every
document has severity 0.  Null text: empty, without features.  Null or repeated doc_id:
each row is scored by itself.  Empty input: empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statframe.llm.common import alnum_words, id_text, stored, text_groups

SAMPLE_TOXIC = 4096
SAMPLE_CLEAN = 8192
MOST_FEATURES = 4096
LEAST_ROOT = 4.5

SCORES = "doc_id long, n_words long, grade long, severity double, p_toxic double"


def word_features(word: bytes) -> list[str]:
    w = word.decode("utf-8", "replace")
    out = ["=" + w]
    for n in (4, 5, 6):
        if len(w) > n:
            out += ["^" + w[:n], "$" + w[-n:]]
    return out


def _sample(rows: DataFrame, labels: DataFrame, n_toxic: int, n_clean: int) -> tuple:
    """The sampled documents with their label, and the labelled counts (clean, toxic)."""
    known = labels.groupBy("label_id").agg(F.max("toxic").alias("toxic"))
    known = stored(known, "labels")
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    order = F.xxhash64("label_id"), F.col("label_id")
    picked = known.filter("toxic = 1").orderBy(*order).limit(n_toxic).unionByName(
        known.filter("toxic = 0").orderBy(*order).limit(n_clean))
    # at most n_toxic + n_clean ids, and of an id that many rows carry one text
    docs = rows.join(F.broadcast(picked), rows.doc_id == picked.label_id).groupBy("label_id").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"),
        F.first("toxic").alias("toxic")).select("text", "toxic")
    return stored(docs, "sample"), sizes.get(0, 0), sizes.get(1, 0)


def _associations(sample: DataFrame) -> tuple[DataFrame, int, int]:
    """Documents with each feature by class."""

    def run(batches):
        got: Counter = Counter()

        def out():
            keys = list(got)
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in keys], pa.string()),
                 pa.array([t for _, t in keys], pa.int32()),
                 pa.array([got[k] for k in keys], pa.int64())], names=["feature", "toxic", "n"])

        for b in text_groups(batches):
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                own = {f for w in set(alnum_words(text)) for f in word_features(w)}
                got.update((f, toxic) for f in own)
            if len(got) > 300_000:
                yield out()
                got.clear()
        yield out()

    n = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    both = (sample.mapInArrow(run, "feature string, toxic int, n long").groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b")))
    return both, n.get(1, 0), n.get(0, 0)


@dataclass
class Model:
    """``features`` name -> number; ``marks`` numbers on the toxic side."""

    features: dict[str, int] = field(default_factory=dict)
    marks: frozenset[int] = frozenset()
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thresholds: np.ndarray = field(default_factory=lambda: np.full(2, np.inf))

    def reader(self, most: int = 250_000):
        """words -> (occurrences by feature, marked words); words' features are remembered."""
        memo: dict[bytes, tuple[int, ...]] = {}

        def read(words: list[bytes]) -> tuple[Counter, int]:
            got, marked = Counter(), 0
            if len(memo) > most:
                memo.clear()
            for w in words:
                own = memo.get(w)
                if own is None:
                    own = memo[w] = tuple(self.features[f] for f in word_features(w)
                                          if f in self.features)
                if own:
                    got.update(own)
                    marked += not self.marks.isdisjoint(own)
            return got, marked

        return read

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= j) for each score and threshold."""
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(self.thresholds[None, :] - score[:, None]))


def fit_cumulative(rows: list[dict[int, float]], grade: np.ndarray, weight: np.ndarray, d: int,
                   penalty: float = 0.3, steps: int = 400) -> tuple[np.ndarray, np.ndarray]:
    """Weights shared by two ordered thresholds, by Adam on the penalised likelihood."""
    r = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
    c = np.array([j for x in rows for j in x], np.int64)
    v = np.array([y for x in rows for y in x.values()], np.float64)
    n = len(rows)

    def gradient(p):
        w, t1, gap = p[:d], p[d], np.exp(p[d + 1])
        s = np.bincount(r, v * w[c], n) if len(c) else np.zeros(n)
        with np.errstate(over="ignore"):
            p1, p2 = 1 / (1 + np.exp(t1 - s)), 1 / (1 + np.exp(t1 + gap - s))
        # d log P(grade) / d (score - t_j)
        g1 = np.where(grade == 0, -p1, np.where(grade == 1, p1 * (1 - p1) /
                                                np.maximum(p1 - p2, 1e-12), 0))
        g2 = np.where(grade == 2, 1 - p2, np.where(grade == 1, -p2 * (1 - p2) /
                                                   np.maximum(p1 - p2, 1e-12), 0))
        g1, g2 = g1 * weight, g2 * weight
        gw = np.bincount(c, v * (g1 + g2)[r], d) if len(c) else np.zeros(d)
        return np.concatenate([gw - penalty * w, [-(g1 + g2).sum(), -g2.sum() * gap]])

    p = np.zeros(d + 2)
    m, q = np.zeros_like(p), np.zeros_like(p)
    for k in range(1, steps + 1):
        g = gradient(p)
        m, q = 0.9 * m + 0.1 * g, 0.99 * q + 0.01 * g * g
        p += 0.1 / np.sqrt(1 + k / 50) * (m / (1 - 0.9 ** k)) / (
            np.sqrt(q / (1 - 0.99 ** k)) + 1e-9)
    return p[:d], np.array([p[d], p[d] + np.exp(p[d + 1])])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_id: str = "doc_id", label_col: str = "toxic", sample_toxic: int = SAMPLE_TOXIC,
        sample_clean: int = SAMPLE_CLEAN, most_features: int = MOST_FEATURES,
        least_root: float = LEAST_ROOT) -> Model:
    """Fit the ordinal model on a bounded sample of the labelled documents."""
    marks = labels.select(F.col(f"`{label_id}`").cast("long").alias("label_id"),
                          (F.col(f"`{label_col}`").cast("int") > 0).cast("int").alias("toxic"))
    sample, n_clean, n_toxic = _sample(id_text(docs, id_col, text_col),
                                       marks.dropna(), sample_toxic, sample_clean)
    both, a_n, b_n = _associations(sample)
    if not a_n or not b_n:
        return Model()

    def part(obs, row, col):
        return F.when(obs > 0, obs * F.log(obs * (a_n + b_n) / (row * col))).otherwise(0.0)

    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    g2 = 2 * (part(a, a + b, F.lit(a_n)) + part(b, a + b, F.lit(b_n)) +
              part(a_n - a, a_n + b_n - a - b, F.lit(a_n)) +
              part(b_n - b, a_n + b_n - a - b, F.lit(b_n)))
    toxic_side = a / a_n > b / b_n
    kept = (both.select("feature", toxic_side.alias("mark"),
                        F.sqrt(F.greatest(g2, F.lit(0.0))).alias("root"))
            .filter(F.col("root") >= least_root)
            .orderBy(F.desc("root"), "feature").limit(most_features).collect())
    model = Model({r.feature: k for k, r in enumerate(kept)},
                  frozenset(k for k, r in enumerate(kept) if r.mark))

    def read(batches):
        reader = model.reader()
        for b in text_groups(batches):
            words = [alnum_words(t) for t in b.column("text").to_pylist()]
            got = [reader(w) for w in words]
            yield pa.RecordBatch.from_arrays(
                [b.column("toxic"),
                 pa.array([m for _, m in got], pa.int64()),
                 pa.array([list(c.items()) for c, _ in got], pa.map_(pa.int32(), pa.int32()))],
                names=["toxic", "marked", "counts"])

    # at most sample_toxic + sample_clean rows of selected features
    got = sample.mapInArrow(read, "toxic int, marked long, counts map<int,int>").collect()
    got.sort(key=lambda r: (r.toxic, r.marked, sorted(r.counts.items())))
    marked = [r.marked for r in got if r.toxic and r.marked]
    middle = float(np.median(marked)) if marked else 0.0
    grade = np.array([0 if not r.toxic else 2 if r.marked > middle else 1 for r in got])
    share = {0: n_clean / b_n, 1: n_toxic / a_n}
    model.weights, model.thresholds = fit_cumulative(
        [{j: float(np.log1p(n)) for j, n in r.counts.items()} for r in got], grade,
        np.array([share[r.toxic] for r in got]), len(kept))
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
          ) -> DataFrame:
    """(doc_id, n_words, grade, severity, p_toxic) of every row; grade is the most likely one."""

    def run(batches):
        reader = model.reader()
        for b in text_groups(batches):
            words = [alnum_words(t) for t in b.column("text").to_pylist()]
            s = np.array([sum(model.weights[j] * np.log1p(n) for j, n in reader(w)[0].items())
                          for w in words], np.float64)
            p = model.at_least(s)
            each = np.stack([1 - p[:, 0], p[:, 0] - p[:, 1], p[:, 1]], axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(w) for w in words], pa.int64()),
                 pa.array(each.argmax(axis=1), pa.int64()), pa.array(p.sum(axis=1)),
                 pa.array(p[:, 0].copy())],
                names=["doc_id", "n_words", "grade", "severity", "p_toxic"])

    return id_text(docs, id_col, text_col).mapInArrow(run, SCORES)
