"""Near duplicates against all pairs, and the sketch's promises."""

import random
from collections import Counter

import numpy as np
import pytest
from odd import empty, frame, rows

from statframe.llm import linking, near_dedup
from statframe.llm.common import space_words


def shingles(text, k=5):
    w = space_words(text or "")
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(docs, percent=75):
    sets = [shingles(t) for _, t, *_ in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, (d, *_) in enumerate(docs):
        groups.setdefault(find(i), []).append(d)
    first = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return Counter((d, len(sets[i]), d if not sets[i] else first[find(i)])
                   for i, (d, *_) in enumerate(docs))


def corpus(seed=1, groups=12, hot=60):
    """Chains and stars of near copies with similarities on both sides of the threshold."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    out = rows(15)
    n = 10_000
    for g in range(groups):
        words = [rng.choice(vocab) for _ in range(rng.choice([6, 30, 120, 400]))]
        for _ in range(hot if g == 0 else rng.randrange(2, 7)):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            if rng.random() < 0.5:
                words = copy  # a chain
            n += 1
            out.append((n, " ".join(copy).title(), "en", "s", 0, "", "", 0, "", 0, ""))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    docs = corpus(seed)
    got = near_dedup.near_dedup(frame(spark, docs).repartition(5))
    assert Counter(tuple(r) for r in got.collect()) == brute(docs)


def test_no_rows(spark):
    assert near_dedup.near_dedup(empty(spark)).count() == 0


def test_every_bin_fills_and_agreement_is_similarity():
    rng = np.random.default_rng(0)
    common, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (900, 50, 50))
    tiny = rng.integers(0, 1 << 63, 1).astype(np.uint64)
    s = near_dedup.sketches([np.unique(np.concatenate([common, a])),
                             np.unique(np.concatenate([common, b])), tiny], 160)
    assert (s != np.iinfo(np.uint64).max).all()
    assert abs((s[0] == s[1]).mean() - 0.9) < 0.08
    # a set's sketch does not depend on the sets beside it
    assert (near_dedup.sketches([tiny], 160) == s[2:]).all()


def test_components_of_paths_stars_and_rings(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + \
        [(200, 201), (201, 202), (202, 200), (7, 7)]
    got = linking.components(spark.createDataFrame(pairs, "a long, b long"))
    want = {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)},
            200: 200, 201: 200, 202: 200}
    assert {r.node: r.root for r in got.collect()} == want


def jaccard(sets, seen):
    """A measure over given sets that keeps the pairs it was asked for."""
    def measure(pairs):
        rows_ = [(r.a, r.b) for r in pairs.collect()]
        seen.extend(rows_)
        out = []
        for a, b in rows_:
            both, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            out.append((a, b, 1 - both / union, 100 * both >= 75 * union))
        return pairs.sparkSession.createDataFrame(
            out, "a long, b long, distance double, linked boolean")
    return measure


@pytest.mark.parametrize("at_once", [0, 1000])
def test_linking_finds_links_beside_the_hub(spark, monkeypatch, at_once):
    """In one bucket: the hub is linked with nobody, the others in groups; by turns and at once."""
    monkeypatch.setattr(linking, "AT_ONCE", at_once)
    sets = {i: {f"{i}"} | ({f"g{i % 5}-{k}" for k in range(20)} if i else set())
            for i in range(30)}
    cand = spark.createDataFrame([(1, i, 21) for i in range(30)],
                                 "key long, node long, size long")
    seen = []
    got = {r.node: r.root for r in linking.link(cand, jaccard(sets, seen), 75).collect()}
    assert got == {i: (i % 5 or 5) for i in range(1, 30)}
    assert len(seen) == len(set(seen))


def test_linking_skips_what_sizes_and_hubs_exclude(spark):
    """A large group of copies with strangers in its bucket: few tests per stranger."""
    rng = random.Random(1)
    base = [f"b{k}" for k in range(100)]
    sets = {i: set(base) - {rng.choice(base)} | {f"x{i}"} for i in range(300)}
    sets |= {300 + i: set(base[:50]) | {f"y{i}-{k}" for k in range(50)} for i in range(5)}
    sets[305] = set(base[:60])  # too small to be linked with any copy
    cand = spark.createDataFrame([(1, i, len(s)) for i, s in sets.items()],
                                 "key long, node long, size long")
    seen = []
    got = {r.node: r.root for r in linking.link(cand, jaccard(sets, seen), 75).collect()}
    assert got == {i: 0 for i in range(300)}
    assert len(seen) < 330 and len(seen) == len(set(seen))


def test_near_misses_are_not_tested(spark, monkeypatch):
    """Texts that share buckets, but are too far apart for a link, make no pairs."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(300)]
    texts = []
    for n in range(40):
        t = list(base)
        for i in rng.sample(range(300), 8):
            t[i] = f"x{n}y{i}"
        texts.append(" ".join(t))
    docs = [(n, t) for n, t in enumerate(texts)] + [(99, texts[7] + " end")]
    tested, link = [], near_dedup.link

    def linked(candidates, measure, percent):
        def watched(pairs):
            tested.extend((r.a, r.b) for r in pairs.collect())
            return measure(pairs)
        return link(candidates, watched, percent)

    monkeypatch.setattr(near_dedup, "link", linked)
    got = near_dedup.near_dedup(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in got.collect()} == {**{n: n for n in range(40)}, 99: 7}
    assert 1 <= len(tested) <= 60  # of 820
