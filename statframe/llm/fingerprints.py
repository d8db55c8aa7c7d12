"""Document fingerprints of closed syncmers (operator 11, DataFrame functions only).

A text's tokens are its runs of characters other than blanks (space, U+0009..U+000D), cut into pieces
of up to PIECE characters.  Of every K consecutive tokens (a k-mer) the S-token substrings are
hashed; the k-mer is an anchor, a closed syncmer, if the smallest of these hashes stands at its
left or right edge.  Whether a k-mer is one depends on its own tokens alone, never on what stands
around it, so an edit changes only the anchors that it touches, and of any K - S + 1 consecutive
k-mers at least one is an anchor.  A text with fewer than K tokens is one anchor, one without tokens has
none.

``anchors`` gives (pos, hash) of each anchor, ``matched`` the anchors that two texts share, in
their positions, and ``likeness`` the Jaccard similarity of two anchor sets (1 for two texts without
anchors).  ``encode`` writes the hashes in text order as base64, four bytes each: all anchors, not
a sample.

``with_next`` puts each document's successor (descending doc_id, after the last the first) beside
it in one shuffle: rows go to ranges of doc_id whose bounds are doc_ids of the table (at most
MOST_RANGES of them on the driver), and the first rows of a range also go to the range before.

Null text: empty.  Null doc_id: after all others, by text.  Rows that repeat a doc_id follow each
other by the hash of their text, in one range.  A single document is its own successor.  Empty table:
empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statframe.llm.common import id_text

PIECE, K, S = 3, 12, 3
TOKEN = rf"[^\x20\x09-\x0D]{{1,{PIECE}}}"
#: documents of a range, and the most ranges: beyond, ranges grow
RANGE_ROWS, MOST_RANGES = 256, 1 << 16


def tokens(text: Column) -> Column:
    """The hashes of a text's tokens."""
    return F.transform(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), lambda t: F.xxhash64(t))


def with_anchors(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """``df`` with the anchors of a text column: (pos, hash) structs in text order, pos counting
    tokens from 0."""
    h, g = F.col(f"{out}_h"), F.col(f"{out}_g")
    last, zero = K - S, F.lit(0)  # the last substring of a k-mer

    def once(array, f):
        """f of an array that a lambda's variable holds: a column is unpacked at each use."""
        return F.get(F.transform(F.array(array), f), zero)

    def substring_hashes(hs):
        def one(i):
            x = F.get(hs, i)
            for j in range(1, S):
                x = F.xxhash64(x, F.get(hs, i + j))
            return x
        return F.transform(F.sequence(zero, F.size(hs) - S), one)

    def syncmers(gs):
        def smallest(i, edge, others):
            """Whether an edge is as small as all others; the comparisons end at the first that is not."""
            return reduce(and_, [F.get(gs, i + edge) <= F.get(gs, i + j) for j in others])

        return F.filter(F.sequence(zero, F.size(gs) - last - 1), lambda i: smallest(
            i, 0, range(1, last + 1)) | smallest(i, last, range(last - 1, -1, -1)))

    own = df.withColumn(f"{out}_h", tokens(F.col(text_col)))
    short = F.size(h) < K
    own = own.withColumn(f"{out}_g", F.when(short, F.array().cast("array<bigint>")).otherwise(
        once(h, substring_hashes)))
    at = once(g, syncmers)
    whole = F.transform(at, lambda i: F.struct(
        i.cast("long").alias("pos"), F.xxhash64(F.slice(h, i + 1, F.lit(K))).alias("hash")))
    one = F.array(F.struct(zero.cast("long").alias("pos"), F.xxhash64(h).alias("hash")))
    none = F.slice(one, 1, 0)
    return own.withColumn(out, F.when(F.size(h) == 0, none).when(short, one).otherwise(whole)).drop(
        f"{out}_h", f"{out}_g")


def encode(anchors: Column) -> Column:
    """The fingerprint as text: four bytes of each anchor's hash, in text order, as base64."""
    four = F.transform(anchors, lambda a: F.lpad(F.hex(a.hash.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
    # some versions of base64 break lines
    return F.regexp_replace(F.base64(F.unhex(F.array_join(four, ""))), r"[\r\n]+", "")


def hashes(anchors: Column) -> Column:
    return F.array_distinct(F.transform(anchors, lambda a: a.hash))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def matched(a: Column, b: Column) -> Column:
    """(pos, other_pos) of a's anchors and the first of b's with the same hash: the places where
    two texts run alike."""
    found = F.transform(a, lambda x: F.struct(x.pos.alias("pos"), F.array_position(
        F.transform(b, lambda y: y.hash), x.hash).alias("i")))
    pairs = F.transform(found, lambda x: F.struct(
        x.pos.alias("pos"), F.get(b, (x.i - 1).cast("int")).pos.alias("other_pos")))
    return F.filter(pairs, lambda p: p.other_pos.isNotNull())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, anchors, fingerprint) of every document."""
    texts = id_text(docs, id_col, text_col)
    got = with_anchors(texts, "text", "anchors")
    return got.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), "anchors",
                      encode(F.col("anchors")).alias("fingerprint"))


def _ranges(texts: DataFrame) -> tuple[DataFrame, Window]:
    """``texts`` dealt to ranges of doc_id, with the first rows of the next range as guests, and
    the window in which each row's successor is the next one."""
    n, top = texts.agg(F.count("doc_id"), F.max("doc_id")).first()
    parts = min(MOST_RANGES, max(1, -(-n // RANGE_ROWS)))
    bounds = []
    if parts > 1:
        share = ", ".join(repr(i / parts) for i in range(1, parts))
        got = texts.select(F.expr(f"percentile_approx(doc_id, array({share}), {4 * parts + 10000})"))
        bounds = sorted(set(got.first()[0]))
    # the number of bounds below doc_id, by halving; folded into one literal array
    array = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    place = F.lit(0)
    if bounds:
        steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
        place = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, s: F.when(
            F.get(array, at + s - 1) < F.col("doc_id"), at + s).otherwise(at))
    # the last range, of the smallest ids, takes the rows without an id and, as its guest, the first
    own = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(place)
    at_bound = F.array_contains(array, F.col("doc_id")) if bounds else F.lit(False)
    is_top = F.lit(True) if top is None else F.coalesce(F.col("doc_id") == F.lit(top), F.lit(False))
    homes = F.filter(F.array(
        F.struct(F.col("own").alias("range"), F.lit(0).alias("guest")),
        F.when(F.coalesce(at_bound, F.lit(False)), F.struct((F.col("own") + 1).alias("range"),
                                                            F.lit(1).alias("guest"))),
        F.when(is_top, F.struct(F.lit(0).alias("range"), F.lit(1).alias("guest")))),
        lambda x: x.isNotNull())
    spread = texts.withColumn("own", own).select("doc_id", "text", F.inline(homes))
    size = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = Window.partitionBy("range").orderBy(
        "guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")
    return spread.repartition(size, "range"), order


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited, anchors, edited_anchors, next_anchors) of every document, where
    ``edited`` is its text with the last third taken from the start of its successor."""
    dealt, order = _ranges(id_text(docs, id_col, text_col))
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    rows = dealt.select("*", F.lead("text").over(order).alias("next"))
    rows = rows.withColumn("edited", F.concat(
        F.substring("text", F.lit(1), n - cut), F.substring("next", F.lit(1), cut))).drop("next")
    rows = with_anchors(rows, "text", "anchors")
    rows = with_anchors(rows, "edited", "edited_anchors")
    rows = rows.select("*", F.lead("anchors").over(order).alias("next_anchors"))
    return rows.filter("guest = 0").select(
        "doc_id", n.cast("long").alias("n_chars"), "edited", "anchors", "edited_anchors",
        "next_anchors")
