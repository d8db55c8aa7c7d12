"""The corpus pipeline over a small table, stage by stage, with planted cases."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_line_dedup import brute as brute_lines
from test_near_dedup import shingles
from test_text_scans import brute_items

import corpus_pipeline

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def table_rows(seed=11):
    rng = random.Random(seed)
    word = ["".join(rng.choice("bcdfgklmnprstvz") + rng.choice("aeiou") for _ in range(
        rng.randrange(1, 4))) for _ in range(3000)]

    def prose(n):
        return " ".join(rng.choice(word) for _ in range(n))

    docs, labels, plants = [], [], {}
    bench = [(i, prose(40)) for i in range(5)]
    boiler = prose(55)
    for i in range(400):
        lines = [prose(rng.choice([8, 20, 60])) for _ in range(rng.randrange(2, 6))]
        kind = "clean"
        if i % 8 == 0:
            kind = "toxic"
            for _ in range(4):
                lines.insert(rng.randrange(len(lines)), prose(4) + " Vilestan! " + prose(4))
        elif i % 8 == 1:
            kind = "bench"
            w = bench[i % 5][1].split()
            lines.append(prose(3) + " " + " ".join(w[5:25]).upper() + " " + prose(3))
        elif i % 8 == 2:
            kind = "boiler"
            lines.insert(1, boiler)
        plants[i] = kind
        docs.append((i, "\n".join(lines), "en", "src0", 0))
        if i % 2 == 0 or i < 120:
            labels.append((i, 1, int(kind == "toxic")))
    copy = docs[3][1]
    docs += [(900 + k, copy, "en", "src1", 0) for k in range(5)]
    one_line = docs[4][1].replace("\n", " ").split()
    docs.append((950, " ".join(one_line), "en", "s", 0))
    one_line[20] = "changed"
    docs += [(951, " ".join(one_line), "en", "s", 0), (960, None, "en", "s", None),
             (961, "", None, None, 0), (None, prose(30), "en", "s", 0)]
    return docs, labels, bench, plants


@pytest.fixture(scope="module")
def data(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    docs, labels, bench, plants = table_rows()
    spark.createDataFrame(docs, COLUMNS).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return folder, docs, bench, plants


def test_stages_one_by_one(spark, data):
    folder, docs, bench, plants = data
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    after = {}
    now = frame
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.stored(stage(spark, now, folder), name)
        assert now.dtypes == frame.dtypes
        after[name] = [tuple(r) for r in now.collect()]
    # toxicity: planted documents go, all others stay untouched
    assert Counter(after["toxicity"]) == Counter(d for d in docs if plants.get(d[0]) != "toxic")
    # line dedup against all pairs of lines
    gone = {}
    for g in brute_lines(after["toxicity"]).values():
        first = min(g, key=lambda x: (x[0] is None, x[0] or 0, x[2]))
        for d, t, k in g - {first}:
            gone.setdefault(d, set()).add(k)
    want = Counter()
    for d, t, lang, source, n in after["toxicity"]:
        lines = (t or "").split("\n")
        stay = [x for k, x in enumerate(lines) if k not in gone.get(d, ())]
        if stay:
            text = t if d not in gone else "\n".join(stay)
            want[d, text, lang, source, None if text is None else len(text)] += 1
    assert Counter(after["line_dedup"]) == want
    kept = {d[0] for d in after["line_dedup"]}
    assert 3 in kept and not kept & {900, 901, 902, 903, 904}
    # near dedup: the first of each component, documents without words all stay
    sets = {d[0]: shingles(d[1]) for d in after["line_dedup"]}
    ids = sorted(sets, key=lambda d: (d is None, d or 0))
    root = {d: d for d in ids}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                root[find(b)] = find(a)
    assert {d[0] for d in after["near_dedup"]} == {d for d in ids if find(d) == d}
    # decontamination against loops
    hits = {d for (d, _, spans, _), _ in brute_items(after["near_dedup"], bench, 10).items()
            if spans}
    assert hits and hits == {d for d, k in plants.items() if k == "bench"}
    assert Counter(after["decontaminate"]) == Counter(
        d for d in after["near_dedup"] if d[0] not in hits)


def test_run_packs_what_is_left(spark, data):
    folder, docs, _, plants = data
    got = corpus_pipeline.run(spark, folder).collect()
    left = {r.doc_id for r in got}
    assert {d for d, k in plants.items() if k in ("clean", "boiler")} <= left
    assert not left & {d for d, k in plants.items() if k in ("toxic", "bench")}
    fill = Counter()
    for r in got:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 1024
    assert len(fill) <= -(-sum(fill.values()) // 1024) + 8


def test_empty_tables_and_odd_names(spark, data, tmp_path):
    """No rows at all, and columns whose names hold dots or clash with the stages' own."""
    folder, docs, _, _ = data
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    odd = spark.read.parquet(f"{folder}/documents.parquet").withColumns({
        "a.b": F.lit(1), "key": F.lit("k"), "row": F.lit(2), "_gone": F.lit(3)})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, odd, folder)
        assert left.columns == odd.columns, name
        assert left.count() > 0
