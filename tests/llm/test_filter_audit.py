"""The filter audit against a run of every order over every document."""

import random
import re
from fractions import Fraction
from itertools import combinations, permutations
from math import factorial

from odd import empty, frame, rows
from statframe.llm import filter_audit as FA

COLS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
        "toxic_lost", "shapley")


def fails(data):
    first = {}
    for d, t, _ in data:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    out = []
    for d, t, _ in data:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append("".join(f for f, bad in {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": d is not None and d > first[t]}.items() if bad))
    return out


def brute(data, labels):
    """Every order applied to every document, one filter after another."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    bad = fails(data)
    out = {}
    for part in {x or "" for _, _, x in data}:
        docs = [(d, b) for (d, _, x), b in zip(data, bad) if (x or "") == part]
        removed_at, total = {}, dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = docs
            for i, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                removed_at["".join(order), i + 1] = (
                    len(left), len(gone), sum(f in b for _, b in docs) - len(gone),
                    sum(b == f for _, b in docs), sum(d in good for d, _ in gone),
                    sum(d in toxic for d, _ in gone))
                total[f] += len(gone)
        for (o, i), x in removed_at.items():
            out[part, o, i] = (*x, total[o[i - 1]])
    return out


def found(spark, docs, labels):
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return {tuple(r[c] for c in COLS[:3]): tuple(r[c] for c in COLS[3:])
            for r in FA.audit(docs, marks).collect()}


def sample(n=150, seed=5):
    rng = random.Random(seed)
    words = "a b c Dog Élan x# the of 50% straße and q".split()
    out = []
    for i in range(n):
        k = rng.choice([0, 3, 150, 199, 200, 201, 260])
        vocabulary = rng.choice([words, [f"w{j}" for j in range(400)], ["UP", *words]])
        out.append((i, " ".join(rng.choice(vocabulary) for _ in range(k)), rng.choice(["en", "fr", None, ""])))
    out += [(1000 + i, out[rng.randrange(n)][1], "en") for i in range(60)]
    return out


def test_every_order(spark):
    data = sample()
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 1060, 2)] + [(4, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(5)
    got = found(spark, docs, labels)
    assert got == brute(data, labels)
    assert len(got) == 3 * 600
    parts = {k[0] for k in got}
    assert parts == {"en", "fr", ""}


def test_odd_rows(spark):
    """Null ids, texts and parts, repeated rows, clashing columns, long texts."""
    data = [r[:3] for r in rows()]
    labels = [(5, 1, 0), (6, None, 1), (7, 1, None), (None, 1, 1)]
    assert found(spark, frame(spark), labels) == brute(data, labels)


def test_empty(spark):
    assert found(spark, empty(spark), []) == {}


def test_a_third_of_the_rows_are_one_text(spark):
    data = [(i, "same text" if i % 3 == 0 else f"text {i}", "en" if i % 2 else "fr")
            for i in range(900)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string").repartition(7)
    assert found(spark, docs, [(0, 1, 1), (3, 1, 1)]) == brute(data, [(0, 1, 1), (3, 1, 1)])


def test_potential_is_the_games(spark):
    """The recursion against the defining sum over coalitions, and the mean over orders."""
    rng = random.Random(1)
    counts = [("p", m, rng.randrange(50), 0, 0) for m in range(32)]
    g = FA.games(spark.createDataFrame(counts, "part string, mask int, n long, good long, toxic long")).first()
    n = {m: c for _, m, c, _, _ in counts}
    v = [sum(c for m, c in n.items() if m & s) for s in range(32)]
    assert g["removed"] == v

    def potential(s):
        inside = [i for i in range(5) if s >> i & 1]
        return sum(Fraction(factorial(k - 1) * factorial(len(inside) - k), factorial(len(inside)))
                   * v[sum(1 << i for i in t)]
                   for k in range(1, len(inside) + 1) for t in combinations(inside, k))

    assert [Fraction(p, FA.SCALE) for p in g["potential"]] == [potential(s) for s in range(32)]
