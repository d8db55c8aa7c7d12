"""How five document filters interact, over all orders of applying them (operator 12).

Filter f removes a document that fails it and that no filter before it removed.  All that an audit
needs is how many documents of a part fail exactly which filters: a document is a 5-bit mask, and
a part is 32 counts.  ``masks`` takes one scan of the texts and shuffles digests and flags only;
copies of a text are counted before they meet, so a text that a third of all rows hold is one row a
task, and no row goes back to its group.

``audit`` plays the removal game of each part: the worth v(S) of a coalition S is the number of
documents that some filter of S removes.  Its Hart-Mas-Colell potential is found recursively over the
32 coalitions,

    P(empty) = 0,    P(S) = (v(S) + sum of P(S without f) over f in S) / |S|,

and a filter's Shapley value is P(all) - P(all without f).  Sixty times the potential is a whole
number for five filters (lcm of 1..5), so nothing is rounded.  What a filter removes as the next
one after S is v(S with f) - v(S).

Null text: empty.  Null lang: the part ``""``, like an empty one.  Null doc_id: neither smaller nor
larger than another, so such a row is no later copy, makes none, and has no labels.  Rows that repeat a
doc_id are documents of their own, with the labels of that id; none is a copy of another of the same
id.  An id with several label rows is good (toxic) if one of them says so.  No words: fails A only
of the filters on words.  Empty table: empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statframe.llm.common import stored
from statframe.ship import ship

FILTERS = "ABCDE"
WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 200
ALL = (1 << len(FILTERS)) - 1
#: lcm(1..5): the potential times this is whole
SCALE = 60


def text_flags(text: Column) -> dict[str, Column]:
    """Whether a text fails each of the filters that look at it alone."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return {"A": n < MIN_WORDS, "B": 100 * distinct.cast("long") < 50 * n.cast("long"),
            "C": 100 * capitals.cast("long") > 3 * F.char_length(text).cast("long"),
            "D": text.rlike("[#$%&*|]")}


def masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part that fail exactly the filters in
    ``mask`` (bit 0: A), and how many of them are labelled good and toxic."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"))
    bits = sum((F.when(fails, F.lit(1 << FILTERS.index(f))).otherwise(F.lit(0))
                for f, fails in text_flags(F.col("text")).items()), F.lit(0))
    rows = texts.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
                        bits.alias("mask"))
    # rows without an id have no labels: dealt by text, they do not meet in one task
    side = F.when(F.col("doc_id").isNull(), 1 + F.pmod(F.xxhash64("digest"), F.lit(1024))).otherwise(
        F.lit(0).cast("long"))
    marks = labels.select(F.col("doc_id").cast("long").alias("id"), "quality", "toxic").filter(
        "id is not null").groupBy("id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")).withColumn(
        "side", F.lit(0).cast("long"))
    marked = rows.withColumn("id", F.coalesce("doc_id", F.lit(0).cast("long"))).withColumn(
        "side", side).join(marks, ["id", "side"], "left").select(
        "doc_id", "part", "digest", "mask", F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"))
    # copies of a text, first those that share all but doc_id: at most parts x 4 rows a text
    kind = ["digest", "part", "good", "toxic"]
    groups = marked.groupBy(*kind, "doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.first("mask").alias("mask")).groupBy(*kind).agg(
        F.sum("n").alias("n"), F.first("mask").alias("mask"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("no_id"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"))
    groups = stored(groups, "copies")
    first = groups.filter("least is not null").groupBy("digest").agg(
        F.min("least.doc_id").alias("first_id"))
    stay = F.col("no_id") + F.coalesce(
        F.when(F.col("least.doc_id") == F.col("first_id"), F.col("least.n")), F.lit(0))
    split = groups.join(first, "digest", "left").select(
        "part", "good", "toxic", F.inline(F.array(
            F.struct(F.col("mask"), stay.alias("n")),
            F.struct((F.col("mask") + (1 << FILTERS.index("E"))).alias("mask"),
                     (F.col("n") - stay).alias("n")))))
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic")).filter("n > 0")


def games(counts: DataFrame) -> DataFrame:
    """(part, total, exact, removed, good, toxic, potential) of each part.  ``exact[m]`` documents fail
    just the filters of mask m; ``removed[S]``, ``good[S]`` and ``toxic[S]`` are what coalition S
    removes, ``potential[S]`` is SCALE times its potential."""
    size = ALL + 1

    def dense(col: str) -> Column:
        return F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(col))), F.lit(0))
                         for m in range(size)]).cast("array<long>")

    def worth(exact: str) -> Column:
        """v(S) of every coalition: the documents whose mask meets S."""
        return F.transform(F.sequence(F.lit(0), F.lit(ALL)), lambda s: F.aggregate(
            F.sequence(F.lit(0), F.lit(ALL)), F.lit(0).cast("long"),
            lambda n, m: n + F.when(m.bitwiseAND(s) != 0, F.get(exact, m)).otherwise(F.lit(0))))

    part = counts.groupBy("part").agg(F.sum("n").alias("total"), dense("n").alias("exact"),
                                      dense("good").alias("exact_good"),
                                      dense("toxic").alias("exact_toxic"))
    part = part.select("part", "total", "exact", worth("exact").alias("removed"),
                       worth("exact_good").alias("good"), worth("exact_toxic").alias("toxic"))

    def next_potential(done: Column, s: Column) -> Column:
        """``done`` holds the potentials of all coalitions before S, its subsets among them."""
        below = sum((F.when(s.bitwiseAND(F.lit(1 << f)) != 0, F.get(done, s - (1 << f)))
                     .otherwise(F.lit(0)) for f in range(len(FILTERS))), F.lit(0).cast("long"))
        total = F.lit(SCALE) * F.get("removed", s) + below
        members = F.bit_count(s)
        # whole by construction: the remainder is always 0
        return F.concat(done, F.array(((total - total % members) / members).cast("long")))

    return part.withColumn("potential", F.aggregate(
        F.sequence(F.lit(1), F.lit(ALL)), F.array(F.lit(0).cast("long")), next_potential))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step: (part, filter_order, step, filter, kept,
    removed, redundant, unique_fails, good_lost, toxic_lost, shapley, value).  ``shapley`` is the
    sum over all orders of what the filter removes, ``value`` its mean, the Shapley value."""
    game = stored(games(masks(docs, labels, id_col, text_col, part_col)), "games")
    # a list of 120 orders whatever the data, beside each part
    orders = ["".join(x) for x in permutations(FILTERS)]
    each = game.select("*", F.explode(F.split(F.lit(" ".join(orders)), " ")).alias("filter_order"))
    rows = each.select("*", F.posexplode(F.split("filter_order", "")).alias("at", "filter"))
    bits = F.transform(F.split("filter_order", ""), lambda f: F.element_at(F.array(*[
        F.lit(1 << i) for i in range(len(FILTERS))]), F.instr(F.lit(FILTERS), f)))
    before = F.aggregate(F.slice(bits, F.lit(1), F.col("at")), F.lit(0), lambda a, b: a + b)
    rows = rows.withColumn("before", before).withColumn("bit", F.get(bits, F.col("at"))).withColumn(
        "after", F.col("before") + F.col("bit"))

    def gain(col: str) -> Column:
        return F.get(col, F.col("after")) - F.get(col, F.col("before"))

    bit = F.col("bit")
    shapley = (F.get("potential", F.lit(ALL)) - F.get("potential", ALL - bit)) * F.lit(
        len(orders) // SCALE)
    return rows.select(
        "part", "filter_order", (F.col("at") + 1).cast("long").alias("step"), "filter",
        (F.col("total") - F.get("removed", F.col("after"))).alias("kept"), gain("removed").alias("removed"),
        (F.get("removed", bit) - gain("removed")).alias("redundant"),
        F.get("exact", bit).alias("unique_fails"), gain("good").alias("good_lost"),
        gain("toxic").alias("toxic_lost"), shapley.alias("shapley"),
        (shapley / F.lit(len(orders))).alias("value"))
