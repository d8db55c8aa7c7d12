"""Decontamination and licence scans against plain loops."""

from collections import Counter

import pytest
from odd import empty, frame, rows

from statframe.llm import decontaminate, license_scan
from statframe.llm.common import alnum_words


def key(d, n, spans, items):
    return d, n, tuple(spans), tuple(items)


def brute_items(docs, bench, size):
    wins = set()
    for i, t in bench:
        w = alnum_words(t or "")
        wins |= {(tuple(w[k:k + size]), i) for k in range(max(1, len(w) - size + 1) if w else 0)}
    out = Counter()
    for d, t, *_ in docs:
        w = alnum_words(t or "")
        hit, items = [0] * len(w), set()
        for win, i in wins:
            for p in range(len(w) - len(win) + 1):
                if tuple(w[p:p + len(win)]) == win:
                    hit[p:p + len(win)] = [1] * len(win)
                    items.add(i)
        edge = [k for k in range(len(w) + 1)
                if (hit[k] if k < len(w) else 0) != (hit[k - 1] if k else 0)]
        out[key(d, len(w), zip(edge[::2], edge[1::2]),
                sorted(str(i) for i in items if i is not None))] += 1
    return out


def bench_rows():
    text = [r[1] for r in rows() if r[0] and r[0] >= 100]
    part = " ".join(alnum_words(text[5])[k].decode() for k in range(3, 25) if k < len(
        alnum_words(text[5])))
    return [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
            (2, "one TWO, three"), (3, None), (4, ""), (5, "... !"), (None, "unnamed item"),
            (10, "one two three"), (6, "the the the the the the the the the the the the"),
            (7, part), (7, "seven again"), (1, "word")]


def doc_rows():
    extra = ["x alpha beta gamma delta epsilon zeta eta theta iota kappa y one two three four",
             "Alpha-beta gamma.delta\nEPSILON zeta eta theta iota kappa lambda",
             "alpha beta gamma delta epsilon zeta eta theta iota", "the " * 40, "one two",
             "an unnamed item, seven again; one two three one two three", "Word"]
    return rows(30) + [(3000 + i, t, "en", "s", 0, "", "", 0, "", 0, "")
                       for i, t in enumerate(extra)]


@pytest.mark.parametrize("block,size", [(1 << 18, 10), (5, 10), (1 << 18, 3)])
def test_items_against_loops(spark, block, size):
    bench = spark.createDataFrame(bench_rows(), "item_id long, text string")
    got = decontaminate.find_items(frame(spark, doc_rows()), bench, size=size, block_windows=block)
    assert got.columns == ["doc_id", "n_words", "spans", "item_ids"]
    have = Counter(key(r.doc_id, r.n_words, ((s.start, s.end) for s in r.spans), r.item_ids)
                   for r in got.collect())
    assert have == brute_items(doc_rows(), bench_rows(), size)


def test_items_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.find_items(frame(spark), bench).collect()
    assert len(got) == len(rows()) and not any(r.spans for r in got)
    full = spark.createDataFrame(bench_rows(), "item_id long, text string")
    assert decontaminate.find_items(empty(spark), full).count() == 0


LICENCED = [
    "Released under the MIT License. MIT-license, mit. license", "cc by cc by cc", "CC BY-NC 4.0",
    "This work is licensed under the GNU General Public License, version 3.",
    "w " * 47 + "apache license " + "v " * 47 + "gnu general public license",
    "x " * 95 + "gnu general public license " + "y " * 60 + "apache license",
    "Permission is hereby granted, free of cost, to any person obtaining a copy of this software "
    "and associated documentation files to deal in the software without any restriction",
    "z " * 60 + "redistribution and use in source and binary forms with or without modification "
    "are permitted provided that these conditions are met " + "z " * 100,
    "apache " * 300 + "license"]


def test_scan_against_loops(spark):
    docs = rows(20) + [(4000 + i, t, "en", "s", 0, "", "", 0, "", 0, "")
                       for i, t in enumerate(LICENCED)]
    got = license_scan.scan(frame(spark, docs)).collect()
    want = Counter()
    step = license_scan.STRIDE
    for d, t, *_ in docs:
        w = alnum_words(t or "")
        places, blocks = [], []
        for x in license_scan.PHRASES:
            q = alnum_words(x.text)
            places += [(p, x.label) for p in range(len(w)) if w[p:p + len(q)] == q]
        for s in range(0, len(w), step):
            if s and len(w) <= s + step:
                break
            for x in license_scan.NOTICES:
                q = set(alnum_words(x.text))
                share = len(q & set(w[s:s + 2 * step])) / len(q)
                if share >= x.threshold:
                    blocks.append((s, x.label, min(len(w), s + 2 * step), round(share, 9)))
        want[d, len(w), tuple(sorted(places)), tuple(sorted(blocks))] += 1
    have = Counter((r.doc_id, r.n_words, tuple(sorted((p.start, p.label) for p in r.phrases)),
                    tuple(sorted((b.start, b.label, b.end, round(b.containment, 9))
                                 for b in r.blocks))) for r in got)
    assert have == want
    assert sum(bool(r.blocks) for r in got) >= 2


def test_scan_empty(spark):
    assert license_scan.scan(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        license_scan.scan(empty(spark), [license_scan.Template("x", "")])


def test_clashing_columns_change_nothing(spark):
    """The same rows with and without columns named like the operators' own."""
    whole, bare = frame(spark), frame(spark).select("doc_id", "text")
    assert {"n_tokens", "kept", "row", "a.b"} <= set(whole.columns)

    def found(docs):
        return sorted(map(str, license_scan.scan(docs).collect()))

    assert found(whole) == found(bare)
