"""Collocations against a plain count of all phrases, and the trie against a dictionary."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from odd import empty, frame, rows
from statframe.llm import collocations as CO

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(data, min_count, longest=5, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase of every piece."""
    out = []
    by = {}
    for t, lang in data:
        by.setdefault(lang if lang is not None else "und", []).append(t or "")
    for lang, texts in by.items():
        f, n = Counter(), 0
        for t in texts:
            for piece in re.split("[.,;:!?\x0a-\x0d]", t.translate(LOW)):
                w = re.findall("[^\x20\x09]+", piece)
                n += len(w)
                for k in range(1, longest + 1):
                    f.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        inside = {}
        for p, a in good.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(a, inside.get(p[i:i + k], 0))
        got = []
        for p, a in good.items():
            if 100 * inside.get(p, 0) >= 100 * a:
                continue
            score, _, l, r = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                 for k in range(1, len(p)))
            got.append((-score, -a, " ".join(p).encode(), l, r))
        got.sort()
        out += [(lang, i + 1, s.decode(), -a, l, r, n, -score)
                for i, (score, a, s, l, r) in enumerate(got[:top])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def sample(n=400, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["Élan", "AND", "the"]
    fixed = ["new york city", "as far as I know", "one two three four five six", "AND the", "x  y\tz"]
    out = []
    for i in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words) for _ in range(40)]
        out.append(("".join(p + rng.choice([" ", " ", " ", ", ", ".\n", "\r\n"]) for p in parts),
                    rng.choice(["en", "en", "fr", None])))
    return out


@pytest.mark.parametrize("sizes", [{"bits": 1 << 16}, {"block_words": 300, "trie_phrases": 60, "bits": 1 << 12}])
def test_all_levels(spark, sizes):
    """One block a task, and many, with the candidates in several tries."""
    data = sample()
    docs = spark.createDataFrame(data, "text string, lang string").repartition(5)
    for min_count, top in ((20, 2000), (5, 50)):
        got = found(CO.collocations(docs, min_count=min_count, top=top, **sizes))
        assert got == brute(data, min_count, top=top)
        assert max(len(r[2].split()) for r in got) >= 4


def test_odd_rows(spark):
    data = [(r[1], r[2]) for r in rows()]
    assert found(CO.collocations(frame(spark), min_count=3, bits=1 << 14)) == brute(data, 3)
    assert found(CO.collocations(frame(spark), min_count=10 ** 9, bits=1 << 14)) == []
    assert found(CO.collocations(empty(spark), min_count=1, bits=1 << 14)) == []


def test_exact_beyond_64_bits(spark):
    """The score's arithmetic on counts whose products pass 64 bits."""
    from pyspark.sql import functions as F

    rng = random.Random(5)
    data = [(rng.randrange(1, 10 ** 12), rng.randrange(10 ** 12, 10 ** 14), rng.randrange(10 ** 6, 10 ** 13),
             rng.randrange(10 ** 6, 10 ** 13)) for _ in range(300)]
    got = spark.createDataFrame(data, "f long, n long, l long, r long").select(
        "*", F.expr(CO.SCORE).alias("s")).collect()
    assert [int(r["s"]) for r in got] == [1000 * f * n // (l * r) for f, n, l, r in data]


@pytest.mark.parametrize("k,n,vocabulary", [(2, 3000, 60), (3, 5000, 40), (5, 20000, 12), (3, 1, 5)])
def test_trie(k, n, vocabulary):
    rng = np.random.default_rng(k + n)
    gids = np.sort(rng.choice(10 ** 12, vocabulary, replace=False))
    phrases = np.unique(gids[rng.integers(0, vocabulary, (n, k))], axis=0)
    trie = CO.DoubleArrayTrie(phrases)
    text = np.concatenate([gids, [0, 7]])[rng.integers(0, vocabulary + 2, 20000)]
    want = Counter(tuple(text[i:i + k]) for i in range(len(text) - k + 1))
    known, at = np.unique(text, return_inverse=True)
    got = trie.count(trie.symbols(known)[at])
    assert got.tolist() == [want[tuple(p)] for p in trie.phrases]
    assert sorted(map(tuple, trie.phrases)) == sorted(map(tuple, phrases))


def test_a_phrase_in_a_third_of_the_rows(spark):
    data = [("in the beginning was the word", "en")] * 600 + [
        (f"w{i % 7} in the w{i % 5}", "en") for i in range(1200)]
    docs = spark.createDataFrame(data, "text string, lang string").repartition(9)
    assert found(CO.collocations(docs)) == brute(data, 100)


@pytest.mark.parametrize("row_words", [1, 7, 200])
def test_blocks_are_cut_into_small_rows(spark, monkeypatch, row_words):
    """A task's rows are small, whatever its blocks, and no phrase is lost between two of them."""
    rng = random.Random(9)
    data = [(" ".join(rng.choice("abcdefg") + rng.choice(["", "", ","]) for _ in range(60)), "en") for _ in range(90)]
    docs = spark.createDataFrame(data, "text string, lang string").repartition(2)
    tables, store = {}, CO.stored

    def seen(table, name):
        tables[name] = store(table, name)
        return tables[name]

    monkeypatch.setattr(CO, "stored", seen)
    got = found(CO.collocations(docs, min_count=10, bits=1 << 14, row_words=row_words))
    assert got == brute(data, 10)
    # a row ends with the piece that reaches row_words, four bytes a word
    most = tables["coded"].selectExpr("max(length(ids)) AS n").first().n
    assert most <= 4 * (row_words + 60) and tables["blocks"].selectExpr("max(length(ids)) AS n").first().n > 8000


def test_tasks_hold_few_languages(spark, monkeypatch):
    """Blocks are dealt to tasks by language, so that few tasks count a phrase."""
    data = [(lang, f"{lang}one {lang}two {lang}three") for lang in "abcd" for _ in range(300)]
    df = spark.createDataFrame(data, "lang string, text string").repartition(6)
    tables, store = {}, CO.stored

    def seen(table, name):
        tables[name] = store(table, name)
        return tables[name]

    monkeypatch.setattr(CO, "stored", seen)
    words, phrases, totals = CO.frequent_phrases(df, 100, block_words=100, task_words=900)
    assert {r.n for r in totals.collect()} == {900} and phrases.filter("f = 300").count() == 12
    lang = {r.gid: r.lang for r in words.collect()}
    rows = tables["coded"].selectExpr("input_file_name() AS file", "at.gid AS gid").collect()
    files = {(r.file, lang[g]) for r in rows for g in r.gid}
    assert len({f for f, _ in files}) <= 4 and len(files) <= 7


def test_a_level_is_one_pass_however_many_candidates(spark, monkeypatch):
    """No pass over the text for each block of candidates, and no row for each phrase of a task."""
    data = sample()
    docs = spark.createDataFrame(data, "text string, lang string").repartition(5)
    names, sent, store, sending = [], [], CO.stored, CO._sending

    def seen(table, name):
        names.append(name)
        return store(table, name)

    def packed(k, marks, groups):
        sent.append((k, groups))
        return sending(k, marks, groups)

    monkeypatch.setattr(CO, "stored", seen)
    monkeypatch.setattr(CO, "_sending", packed)
    for phrases in (10, 1 << 17):
        names.clear()
        assert found(CO.collocations(docs, min_count=20, trie_phrases=phrases, bits=1 << 16)) == brute(data, 20)
        assert len(names) <= 4 + 4 and len(set(names)) == len(names)
    assert [k for k, _ in sent] == 2 * [2, 3, 4, 5] and sent[0][1] > 50 and sent[4][1] == 1


def test_tasks_send_packed_groups():
    """A task's rows are as many as groups, whatever the number of its phrases."""
    import pyarrow as pa

    gid = pa.array([list(range(1, 301))])
    ids = np.random.default_rng(1).integers(1, 301, 30000)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([CO._pack(ids)], pa.binary()), pa.StructArray.from_arrays([gid], names=["gid"])], names=["ids", "at"])
    got = [r for b in CO._sending(2, None, 7)([batch]) for r in b.to_pylist()]
    assert sorted(r["part"] for r in got) == list(range(7))
    have = Counter()
    for r in got:
        first, second = CO._unpack(r["phrases"]).reshape(2, -1)
        have.update(dict(zip(zip(first.tolist(), second.tolist()), CO._unpack(r["n"]).tolist())))
    assert have == Counter(zip(ids[:-1].tolist(), ids[1:].tolist()))


def test_phrases_of_one_hash_stay_apart(monkeypatch):
    mix = CO._mix
    monkeypatch.setattr(CO, "_mix", lambda words: mix(words) % np.uint64(5))
    rng = np.random.default_rng(2)
    words, n = rng.integers(0, 6, (3, 4000)).astype(np.uint32), rng.integers(1, 9, 4000)
    want = Counter()
    for p, c in zip(words.T.tolist(), n.tolist()):
        want[tuple(p)] += c
    plain = Counter(map(tuple, words.T.tolist()))
    for w, counts, total in ((words, n, want), (words, None, plain),
                             (words[:2], None, Counter(map(tuple, words[:2].T.tolist())))):
        got, f = CO._merged(w, counts)
        assert len(f) == len(total) and dict(zip(map(tuple, got.T.tolist()), f.tolist())) == total


def test_words_are_found_by_columns():
    """The same words and pieces as text by text."""
    import pyarrow as pa

    texts = ["", "  ", "\n", "One  TWO,three", "É à\tb;c\x0b d\x1fe", ".,x.", "x", "one two" * 3, "\r\n a b "]
    block = CO.Block()
    for part in (texts[:3], texts[3:7], texts[7:]):
        block.add(pa.array(part))
    row = block.row("en")
    words = row["words"].to_pylist()
    pieces = lambda ws: [p.split(b" ") for p in b" ".join(ws).replace(b" \n ", b"\n").split(b"\n") if p.strip()]
    have = pieces([b"\n" if i == 0 else words[i - 1] for i in CO._unpack(row["ids"])])
    want = [p for t in texts for p in pieces([w for w in CO.piece_words(t + "\n")])]
    have, want = ([[w for w in p if w] for p in x] for x in (have, want))
    assert have == want
    assert Counter(w for p in want for w in p) == dict(zip(words, row["counts"].tolist()))


@pytest.mark.parametrize("group_words", [1, 40, 1 << 19])
def test_words_are_numbered_in_groups(spark, monkeypatch, group_words):
    """Frequent words are numbered 1, 2, ... across groups, and their counts are whole."""
    monkeypatch.setattr(CO, "GROUP_WORDS", group_words)
    data = [(" ".join(f"w{i % 90} É{i % 7} x{i}" for i in range(j, j + 30)), ["en", "fr", None][j % 3])
            for j in range(300)]
    docs = spark.createDataFrame(data, "text string, lang string").repartition(4)
    words, _, totals = CO.frequent_phrases(docs, 20, 2, block_words=200, bits=1 << 12)
    want = Counter((lang or "und", w) for t, lang in data for w in t.split(" "))
    assert {(r.lang, r.word): r.f for r in words.collect()} == {p: f for p, f in want.items() if f >= 20}
    assert sorted(r.gid for r in words.collect()) == list(range(1, words.count() + 1))
    assert {r.lang: r.n for r in totals.collect()} == {"en": 9000, "fr": 9000, "und": 9000}
