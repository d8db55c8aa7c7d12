"""Exact duplicates against a dictionary."""

import hashlib
from collections import Counter, defaultdict

import pytest
from odd import empty, frame, rows

from statframe.llm import exact_dedup


def brute(data, pick):
    by = defaultdict(list)
    for d, t, *_ in data:
        by[t or ""].append(d)
    out = Counter()
    for t, ids in by.items():
        known = [i for i in ids if i is not None]
        best = pick(known) if known else None
        for i in ids:
            out[i, best, len(ids), i is not None and i == best,
                hashlib.sha256(t.encode()).digest()] += 1
    return out


@pytest.mark.parametrize("keep,pick", [("smallest", min), ("largest", max)])
def test_against_dictionary(spark, keep, pick):
    # a text with a third of all rows, over many runs
    data = rows() + [(5000 + i, "hot", *["x"] * 2, 0, "", "", 0, "", 0, "") for i in range(40)]
    got = exact_dedup.exact_dedup(frame(spark, data).repartition(23), keep=keep, fan=3)
    assert Counter((*r[:4], bytes(r[4])) for r in got.collect()) == brute(data, pick)


def test_no_rows(spark):
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    got = exact_dedup.exact_dedup(frame(spark))
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
