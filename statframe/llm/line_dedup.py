"""Fuzzy duplicate lines (operator 10, DataFrame functions only).

Lines of at least ``min_chars`` characters are compared by their runs of CHARS characters.
A line's sketch has BINS coordinates.  All its distinct runs are hashed into bins, in as many rounds
as a line of few runs needs to fill them, and a bin keeps its smallest hash.
Lines that agree in all coordinates of a band share a bucket; buckets are linked as in
``linking``, and each pair is confirmed by the exact Jaccard similarity of all its runs.
Of each component the line that comes first by (doc_id, text hash, row, line number) stays.

The sketch is one shuffle of the distinct lines: the explosion into runs and the aggregate
behind it find their rows already together.  (Folding a line's runs into its bins inside the row, by
higher-order functions, took five times the CPU: those run interpreted.)

``every_line_links`` takes all lines of CHARS characters or more this way, and each shorter line
as its own one run: exact copies of it are one component.  ``line_links`` leaves
lines shorter than ``min_chars`` out, or with ``short`` compares them as wholes.

Null text: no lines.  Blank lines have no row and are never dropped.  Null
doc_id: sorts last.  Rows that repeat doc_id and text: one of them keeps the line; ``drop_lines``, which
can't tell such rows apart, keeps it in all of them.  Empty input: empty
result.  Extra columns are ignored by ``line_links`` and kept by ``drop_lines``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statframe.llm.common import forget, id_text, release, stored
from statframe.llm.linking import PARITIES, link, marked

CHARS = 8
ROWS, BANDS = 4, 12
BINS = ROWS * BANDS
#: hashes a line gets at least, three a bin.  Bins left empty cost no pair: two lines agree in a bin that
#: both leave empty, and else with the probability of their similarity
LEAST_HASHES = 3 * BINS
MIN_CHARS = 20
PERCENT = 80

_ALL = rf"(?s)(?=(.{{{CHARS}}}))"


def _doc_key():
    """With doc_id, the key of a document row; equal for repeated rows only."""
    return F.xxhash64("text", "doc_id").alias("dk")


def _lines(texts: DataFrame, min_chars: int, short: bool = False) -> DataFrame:
    """One row per line that is compared, ``sketched`` or as a whole; h1 and h2 are independent
    hashes of it."""
    # the text is hashed and split once a row and left behind, not carried along with each of its lines
    every = texts.select("doc_id", _doc_key(), F.monotonically_increasing_id().alias("rid"),
                         F.split("text", "\n").alias("all")).select(
        "doc_id", "dk", "rid", F.posexplode("all").alias("line_no", "line"))
    every = every.filter(F.col("line").rlike(r"\S")).withColumn(
        "sketched", F.char_length("line") >= min_chars)
    return every.filter(F.col("sketched") | F.lit(short)).select(
        "doc_id", "dk", "rid", "line_no", "line", "sketched", F.xxhash64("line").alias("h1"),
        F.xxhash64(F.lit(1), "line").alias("h2"))


def _run_hashes(wide):
    """The distinct runs of a line in UTF-32, as hashes: repeated ones add nothing to the bins."""
    last = F.floor(F.octet_length(wide) / 4).cast("int") - CHARS
    return F.array_distinct(F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(
        F.substring(wide, i * 4 + 1, F.lit(4 * CHARS)))))


def _hashed_runs(lines: DataFrame) -> DataFrame:
    """(h1, s): the hashes of each line's runs."""
    # four bytes a character: any run can be cut out directly.  As a lambda's variable, for a row
    # hands out a column's bytes as a copy each time
    return lines.select("h1", F.get(F.transform(F.array(F.encode("line", "UTF-32")), _run_hashes),
                                    F.lit(0)).alias("s"))


def _marks(content: DataFrame) -> DataFrame:
    """(node, size, p0, ...): number and parities of each line's runs."""
    runs = _hashed_runs(content).select("h1", F.size("s").alias("size"), F.explode("s").alias("s"))
    at, bit = F.col("s").bitwiseAND(PARITIES - 1), F.shiftrightunsigned("s", 32).bitwiseAND(63)
    turned = F.call_function("shiftleft", F.lit(1).cast("long"), bit.cast("int"))
    return runs.groupBy(F.col("h1").alias("node"), "size").agg(*[
        F.bit_xor(F.when(at == i, turned).otherwise(F.lit(0).cast("long"))).alias(f"p{i}")
        for i in range(PARITIES)])


def _buckets(lines: DataFrame) -> DataFrame:
    """(key, node): the bands of each distinct line."""
    # two lines with one h1 are left to the exact comparison by h1 and h2
    distinct = lines.groupBy("h1").agg(F.first("line").alias("line"), F.min("h2").alias("lo"),
                                       F.max("h2").alias("hi")).filter("lo = hi")
    runs = _hashed_runs(distinct)
    rounds = F.ceil(F.lit(float(LEAST_HASHES)) / F.size("s")).cast("int")
    # rounds first: the runs of a line are taken apart once a round, each into one hash
    hashed = (runs.select("h1", "s", F.explode(F.sequence(F.lit(1), rounds)).alias("r"))
              .select("h1", "r", F.explode("s").alias("s"))
              .select("h1", "r", F.xxhash64("r", "s").alias("v")))
    # the round stands above the hash: a bin keeps what it got first.  A band's bins are one group
    value = F.shiftleft(F.col("r").cast("long"), 48).bitwiseOR(F.shiftrightunsigned("v", 16))
    place = F.pmod("v", F.lit(BINS))
    placed = hashed.select("h1", F.floor(place / ROWS).alias("band"), (place % ROWS).alias("at"),
                           value.alias("value"))
    bands = placed.groupBy("h1", "band").agg(*[
        F.min(F.when(F.col("at") == i, F.col("value"))).alias(f"v{i}") for i in range(ROWS)])
    # a bin that all rounds left empty is a coordinate too: it agrees with an empty one
    return bands.select(F.xxhash64("band", *[F.coalesce(f"v{i}", F.lit(-1)) for i in range(ROWS)])
                        .alias("key"), F.col("h1").alias("node"))


def line_links(docs: DataFrame, min_chars: int = MIN_CHARS, percent: int = PERCENT,
               id_col: str = "doc_id", text_col: str = "text", short: bool = False) -> DataFrame:
    """(doc_id, dk, line_no, component, kept) of every line that is compared; with ``short`` of
    every line that is not blank."""
    if min_chars < CHARS:
        raise ValueError(f"min_chars must be at least {CHARS}")
    lines = _lines(id_text(docs, id_col, text_col), min_chars, short)
    sketched = lines.filter("sketched")
    # the bands go through one shuffle, and only those that nodes share are written
    of_key = Window.partitionBy("key")
    busy = stored(_buckets(sketched).select(
        "key", "node", F.min("node").over(of_key).alias("lo"), F.max("node").over(of_key).alias("hi"))
        .filter("lo != hi").select("key", "node"), "busy")
    release(busy.sparkSession)
    wanted = busy.select(F.col("node").alias("h1")).distinct()
    content = stored(sketched.select("h1", "line").join(wanted, "h1", "left_semi")
                     .groupBy("h1").agg(F.first("line").alias("line")), "texts")
    release(busy.sparkSession)

    def measure(pairs: DataFrame) -> DataFrame:
        # a hub with many members is met by its members in groups of 256
        parts = pairs.groupBy("b").agg(F.ceil(F.count("*") / 256).alias("parts"))
        members = pairs.join(parts, "b").select(
            "a", "b", F.pmod(F.xxhash64("a"), "parts").alias("part"))
        # lines go through the joins, their runs, many times as long, are cut behind them
        own = content.select(F.col("h1").alias("a"), F.col("line").alias("line_a"))
        hubs = (parts.join(content.select(F.col("h1").alias("b"), F.col("line").alias("line_b")), "b")
                .select("b", "line_b", F.explode(F.sequence(F.lit(0).cast("long"),
                                                            F.col("parts") - 1)).alias("part")))
        both = members.join(own, "a").join(hubs, ["b", "part"]).select(
            "a", "b", _runs("line_a").alias("x"), _runs("line_b").alias("y")).select(
            "a", "b", F.size("x").alias("x"), F.size("y").alias("y"),
            F.size(F.array_intersect("x", "y")).alias("n"))
        union = F.col("x") + F.col("y") - F.col("n")
        return both.select("a", "b", (1 - F.col("n") / union).alias("distance"),
                           (100 * F.col("n") >= percent * union).alias("linked"))

    marks = stored(_marks(content), "marks")
    labels = link(marked(busy.withColumn("size", F.lit(1)), marks), measure, percent)
    # the line's key in its own right: h2 tells lines apart that share h1.  Written: the row numbers
    # must not change
    occ = stored(lines.drop("line").join(
        labels.select(F.col("node").alias("h1"), "root"), "h1", "left").withColumn(
        "root", F.when(F.col("sketched"), F.col("root"))).select(
        "doc_id", "dk", "rid", "line_no", F.coalesce("root", "h1").alias("component"),
        F.when(F.col("root").isNull(), F.col("h2")).alias("h2")), "occurrences")
    forget(busy, content, marks)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "dk", "rid", "line_no")
    first = occ.groupBy("component", "h2").agg(F.min(place).alias("p")).select(
        "p.rid", "p.line_no", F.lit(True).alias("kept"))
    return occ.join(first, ["rid", "line_no"], "left").select(
        "doc_id", "dk", "line_no", "component", F.coalesce("kept", F.lit(False)).alias("kept"))


def every_line_links(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``line_links`` of every line that is not blank, whatever its length."""
    return line_links(docs, CHARS, percent, id_col, text_col, short=True)


def _runs(line: str):
    return F.array_distinct(F.regexp_extract_all(line, F.lit(_ALL), F.lit(1)))


def drop_lines(docs: DataFrame, links: DataFrame, id_col: str = "doc_id", text_col: str = "text"
               ) -> DataFrame:
    """``docs`` without the lines that ``links`` drops, all columns kept in place.  A document all
    of whose lines go goes too, and so does one that only blank lines are left of, if it had others."""
    # of rows that repeat one, a line goes where none of them keeps it
    gone = links.groupBy("doc_id", "dk", "line_no").agg(F.max("kept").alias("kept")).filter(
        "not kept").groupBy("doc_id", "dk").agg(F.collect_list("line_no").alias("gone")).select(
        F.col("doc_id").alias("_gone_id"), F.col("dk").alias("_gone_dk"), F.col("gone").alias("_gone"))
    names = docs.columns
    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    keyed = docs.select(row).select(
        "row", F.col(f"row.`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit("")).alias("text"))
    # the text goes through the join once, and is split behind it
    keyed = keyed.select("row", "doc_id", _doc_key())
    both = keyed.join(gone, keyed.doc_id.eqNullSafe(F.col("_gone_id")) &
                      (F.col("dk") == F.col("_gone_dk")), "left").withColumn("lines", F.split(
                          F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit("")), "\n"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("_gone"))
    text = F.when(F.col("_gone").isNull(), F.col(f"row.`{text_col}`")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    def some(numbers):
        return F.exists(numbers, lambda i: F.get("lines", i).rlike(r"\S"))

    # without a line left, or with blank ones only where others went
    whole = (F.size(stay) > 0) & (some(stay) | ~some(F.col("_gone")))
    return both.filter(F.col("_gone").isNull() | whole).select(
        *[(text if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in names])
