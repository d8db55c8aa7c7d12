"""The ``opN_`` queries of the operators and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statframe.llm import collocations as CO
from statframe.llm import decontaminate as DC
from statframe.llm import exact_dedup as ED
from statframe.llm import filter_audit as FA
from statframe.llm import fingerprints as FP
from statframe.llm import hmm_lm as LM
from statframe.llm import id_files as IF
from statframe.llm import license_scan as LS
from statframe.llm import line_dedup as LD
from statframe.llm import near_dedup as ND
from statframe.llm import packing as PK
from statframe.llm import token_counts as TC
from statframe.llm import toxicity as TX
from statframe.session import scratch_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

VOCAB = public_tokenizers.path("byte_bpe_50k.json")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark, sf):
    """Token counts of every document."""
    got = TC.token_counts(table(spark, sf, "documents"), VOCAB)
    return got.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


@query
def op4_packing(spark, sf):
    """All documents packed into sequences of at most 1024 tokens."""
    got = PK.pack(table(spark, sf, "documents"), VOCAB, separator_id=0, capacity=1024)
    return got.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset")


@query
def op5_id_files(spark, sf):
    """Documents written as id files in doc_id order and read back."""
    path = scratch_path(spark, "ids")
    IF.write_id_files(table(spark, sf, "documents"), path, VOCAB, end_id=2)
    return IF.read_id_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op6_exact_dedup(spark, sf):
    """Copies of every text; the largest doc_id stays."""
    got = ED.exact_dedup(table(spark, sf, "documents"), keep="largest")
    return got.select("doc_id", "keep_id", "group_size", "kept",
                      F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE["op6_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW g AS (PARTITION BY t)
"""


@query
def op8_decontaminate(spark, sf):
    """Document words inside 10-word windows of benchmark items."""
    got = DC.find_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"), size=10)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.end - s.start)
    return got.select("doc_id", "n_words", n_hit.alias("n_hit"),
                      F.size("item_ids").cast("long").alias("n_items"),
                      F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
                      .alias("items_sha256"), (n_hit > 0).alias("contaminated"))


_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE["op8_decontaminate"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  coalesce({_WORDS}, []) AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
win AS (SELECT DISTINCT item_id, w[p:p + 9] AS ws
        FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS p
              FROM i WHERE len(w) > 0)),
key AS (SELECT item_id, len(ws) AS n, array_to_string(ws, ' ') AS k FROM win),
lens AS (SELECT DISTINCT n FROM key),
place AS (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS p FROM d, lens WHERE len(w) >= n),
hit AS (SELECT r, p, key.n, item_id FROM place JOIN key
        ON key.n = place.n AND key.k = array_to_string(w[p:p + place.n - 1], ' ')),
word AS (SELECT r, count(DISTINCT x) AS n_hit
         FROM (SELECT r, unnest(range(p, p + n)) AS x FROM hit) GROUP BY r),
item AS (SELECT r, count(DISTINCT item_id) AS n_items,
                string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
         FROM hit GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (r) LEFT JOIN item USING (r)
"""


@query
def op9_license_scan(spark, sf):
    """Licence phrases and notices in every document."""
    got = LS.scan(table(spark, sf, "documents"))
    base = F.array_join(F.array_sort(F.array_distinct("phrases.label")), ",")
    both = F.array_join(F.array_sort(F.array_union("phrases.label", "blocks.label")), ",")
    score = F.when(F.size("phrases") > 0, F.lit(1.0)).otherwise(
        F.coalesce(F.array_max("blocks.containment"), F.lit(0.0)))
    return got.select("doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"),
                      F.array_min("phrases.start").alias("first_word"),
                      F.array_max("phrases.start").alias("last_word"), base.alias("base_labels"),
                      both.alias("labels"), score.alias("score"))


@query
def op7_toxicity(spark, sf):
    """Expected severity of every document, by the model fitted on the labelled sample."""
    docs = table(spark, sf, "documents")
    got = TX.score(docs, TX.fit(docs, table(spark, sf, "labels")))
    return got.select("doc_id", "n_words", "grade", F.round("severity", 9).alias("severity"),
                      F.round("p_toxic", 9).alias("p_toxic"),
                      (F.col("p_toxic") >= 0.5).alias("toxic"))


@query
def op3_hmm_lm(spark, sf):
    """Log10 likelihood of every document under the hidden Markov model."""
    held = "crc32(cast(coalesce(cast(doc_id AS string), '') AS binary)) % 7 = 2"
    got = LM.score(table(spark, sf, "documents"), held)
    return got.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                      F.col("base").alias("base_score"), "score")


@query
def op2_near_dedup(spark, sf):
    """Components of near-duplicate documents."""
    got = ND.near_dedup(table(spark, sf, "documents"))
    return got.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"),
                                             F.lit(False)))


@query
def op10_line_dedup(spark, sf):
    """Every line that is not blank with its component; one line of each stays."""
    got = LD.every_line_links(table(spark, sf, "documents"))
    return got.select("doc_id", "line_no", "component", "kept")


@query
def op11_fingerprints(spark, sf):
    """Closed-syncmer fingerprints of every document and of its edited text."""
    got = FP.with_next(table(spark, sf, "documents"))
    got = got.select("*", *[FP.hashes(F.col(c)).alias(f"{c}_set") for c in (
        "anchors", "edited_anchors", "next_anchors")])
    return got.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        FP.encode(F.col("anchors")).alias("fingerprint"),
        FP.encode(F.col("edited_anchors")).alias("edited_fingerprint"),
        FP.likeness(F.col("anchors_set"), F.col("edited_anchors_set")).alias("near_edited"),
        FP.likeness(F.col("anchors_set"), F.col("next_anchors_set")).alias("near_next"))


@query
def op12_filter_audit(spark, sf):
    """What each of five filters removes, in every order of applying them."""
    got = FA.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return got.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                      "good_lost", "toxic_lost", "shapley")


ORACLE["op12_filter_audit"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
      FROM labels GROUP BY doc_id),
x AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             (CASE WHEN len(w) < 200 THEN 1 ELSE 0 END)
             + (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END)
             + (CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))
                          > 3 * length(t) THEN 4 ELSE 0 END)
             + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
             + (CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS m
      FROM d LEFT JOIN g ON d.doc_id = g.doc_id),
c AS (SELECT part, m, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM x GROUP BY ALL),
f AS (SELECT unnest(range(5)) AS f),
o AS (SELECT [a.f, b.f, c.f, d.f, e.f] AS fs FROM f a, f b, f c, f d, f e
      WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT fs, array_to_string(list_transform(fs, lambda i: substr('ABCDE', i + 1, 1)), '') AS filter_order,
             step, fs[step] AS f,
             coalesce(list_sum(list_transform(fs[1:step - 1], lambda i: 1 << i)), 0)::BIGINT AS b
      FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, f,
             sum(CASE WHEN m & (b + (1 << f)) = 0 THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN m & b = 0 AND m & (1 << f) <> 0 THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN m & b <> 0 AND m & (1 << f) <> 0 THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN m = (1 << f) THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN m & b = 0 AND m & (1 << f) <> 0 THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN m & b = 0 AND m & (1 << f) <> 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM c, s GROUP BY ALL)
SELECT part, filter_order, step::BIGINT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM r
"""


@query
def op13_collocations(spark, sf):
    """The 2,000 strongest collocations of each language."""
    return CO.collocations(table(spark, sf, "documents"), min_count=100, longest=5, top=2000)


ORACLE["op13_collocations"] = r"""
WITH p AS (SELECT lang, row_number() OVER () AS p, w
      FROM (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
            FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text,
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)) WHERE len(w) > 0),
t AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM p GROUP BY lang),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS s
      FROM (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i
            FROM p, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, s, count(*)::HUGEINT AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k, s, f, string_split(s, ' ') AS w FROM f WHERE k > 1),
inner_ AS (SELECT lang, s, max(f) AS around
      FROM (SELECT lang, f, array_to_string(w[i:i + j - 1], ' ') AS s
            FROM (SELECT lang, f, w, j, unnest(range(1, k - j + 2)) AS i
                  FROM (SELECT lang, f, w, k, unnest(range(2, k)) AS j FROM c))) GROUP BY ALL),
left_ AS (SELECT c.* FROM c LEFT JOIN inner_ x ON x.lang = c.lang AND x.s = c.s
      WHERE x.around IS NULL OR 100 * x.around < 100 * c.f),
cut AS (SELECT c.lang, c.s, c.f AS a, x.f AS l, y.f AS r, t.n, j,
               (1000 * c.f * t.n) // (x.f * y.f) AS score
      FROM (SELECT *, unnest(range(1, k)) AS j FROM left_) c
      JOIN t ON t.lang = c.lang
      JOIN f x ON x.lang = c.lang AND x.s = array_to_string(c.w[1:j], ' ')
      JOIN f y ON y.lang = c.lang AND y.s = array_to_string(c.w[j + 1:], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, s ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, s) AS rank FROM best)
SELECT lang, rank::BIGINT AS rank, s AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
       n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""
