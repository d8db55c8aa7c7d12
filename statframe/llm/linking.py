"""Links and components over candidate buckets, in DataFrame functions only.

``link`` takes (key, node, size) rows, where nodes that may belong together share a key, and a
function that measures pairs on their full content.  It does not test all pairs of a bucket:

* first every node is tested against one hub only, the smallest node of one of its
  buckets (the one that it shares most buckets with);
* nodes that are connected by then need no further test.  In buckets that still hold several
  components, the nodes of the smaller ones are tested against the hubs of the others;
* Jaccard distance obeys the triangle inequality, so a node y at distance d(h, y) from a hub h
  can't be linked with a node x at d(h, x) < d(h, y) - allowed distance.  What this does not
  exclude is tested: all at once where it is no more than a few pairs per candidate row, else by
  turns of 1, 4, 16, ... nodes per bucket, joining components after each turn.

With ``marked`` candidates no pair is tested, nor a row made for it, that the parities of its sets
exclude: an element that only one set has turns one bit, so where more bits differ than linked sets
of these sizes have elements apart, the pair isn't linked.  This loses no link.  It takes the place of
the hubs' distances; the pairs of a bucket across components are still compared, bit by bit, by several tasks
where the bucket is large.

So a group of copies of any size costs one test per member and a few per stranger in its
buckets, and no link between different components is lost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from statframe.llm.common import forget, placed
from statframe.session import scratch_path

#: pairs across components that are tested at once, per candidate row
AT_ONCE = 4


#: nodes of a bucket that one task compares with the rest of it
PART = 1024
#: longs of a set's parities: 1024 bits tell sets of up to about 1,700 elements apart
PARITIES = 16


def marked(candidates: DataFrame, marks: DataFrame) -> DataFrame:
    """``candidates``, which remembers the ``marks`` of its nodes: (node, size, p0, p1, ...), where bit b
    of p0, p1, ... is the parity of the number of elements of the node's set with hash b."""
    candidates.marks = marks
    return candidates


def _stored(df: DataFrame, name: str) -> tuple[DataFrame, int, int]:
    """Write ``df`` to the shared folder; the table read back, its rows and an order-independent
    digest of them, both taken while writing."""
    spark, seen = df.sparkSession, Observation()
    path = scratch_path(spark, name)
    df.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(
        F.xxhash64(*df.columns)).alias("x")).write.option("compression", "zstd").parquet(path)
    got = seen.get
    return placed(spark.read.schema(df.schema).parquet(path), path), got["n"], got["x"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) can reach, by
    alternating large-star and small-star rounds.  Every round is stored, so that a lost
    executor costs no more than its own tasks."""

    def stars(e: DataFrame) -> DataFrame:
        # large star: every larger neighbour of u, over both directions, to u's smallest
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        best = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(best, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: every smaller neighbour of u, and u itself, to the smallest
        best = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(best, "u").filter("v != m").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        return small.unionByName(best.select("u", F.col("m").alias("v"))).distinct()

    e, n, x = _stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .filter("u != v").distinct(), "edges")
    while n:
        was, old = (n, x), e
        e, n, x = _stored(stars(e), "edges")
        forget(old)
        if was == (n, x):
            break
    # every edge now leads to a root
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after further links: only the roots that these touch take part."""
    def root_of(side):
        return links.join(labels.select(F.col("node").alias(side), F.col("root").alias(
            f"root_{side}")), side, "left").withColumn(side, F.coalesce(f"root_{side}", side))

    links = root_of("a").select("a", "b")
    links = root_of("b").select("a", "b").distinct()
    new = components(links).select(F.col("node").alias("old"), F.col("root").alias("new"))
    moved = labels.join(new, labels.root == new.old, "left").select(
        "node", F.coalesce("new", "root").alias("root"))
    fresh = new.join(labels.select(F.col("node").alias("old")), "old", "left_anti").select(
        F.col("old").alias("node"), F.col("new").alias("root"))
    return _stored(moved.unionByName(fresh), "labels")[0]


def link(candidates: DataFrame, measure: Callable[[DataFrame], DataFrame], percent: int,
         turn: int = 4) -> DataFrame:
    """(node, root) of all nodes with a confirmed link.  ``candidates``: (key, node, size);
    ``measure`` takes pairs (a, b) and returns (a, b, distance, linked) of each, with the Jaccard
    distance of their sets.  Nodes with 100 * smaller size < ``percent`` * larger size are never
    linked, nor are nodes at a distance above 1 - ``percent`` / 100."""
    allowed = 1 - percent / 100 + 1e-9
    marks = getattr(candidates, "marks", None)
    parities = [c for c in marks.columns if c not in ("node", "size")] if marks is not None else []
    lowest = candidates.groupBy("key").agg(F.min(F.struct("node", "size")).alias("hub"),
                                           F.max("node").alias("last"))
    shared, n_rows, _ = _stored(
        candidates.join(lowest.filter("hub.node != last").drop("last"), "key").distinct(),
        "buckets")

    def may(x: str, y: str):
        """Whether sizes and parities leave a link of x and y possible."""
        small, large = F.least(f"size_{x}", f"size_{y}"), F.greatest(f"size_{x}", f"size_{y}")
        ok = 100 * small >= percent * large
        if parities:
            apart = sum(F.bit_count(F.col(f"{p}_{x}").bitwiseXOR(F.col(f"{p}_{y}"))) for p in parities)
            ok &= (100 + percent) * apart <= (100 - percent) * (small + large)
        return ok

    def marks_of(side: str) -> DataFrame:
        return marks.select(*[F.col(c).alias(f"{c}_{side}") for c in ("node", "size", *parities)])

    hub_of, _, _ = _stored(
        shared.filter(F.col("node") != F.col("hub.node"))
        .select("node", F.col("size").alias("size_x"), F.col("hub.node").alias("hub"),
                F.col("hub.size").alias("size_y"))
        .filter(100 * F.least("size_x", "size_y") >= percent * F.greatest("size_x", "size_y"))
        .groupBy("node", "hub").count().groupBy("node").agg(
            F.max(F.struct("count", (-F.col("hub")).alias("hub"))).alias("x"))
        .select(F.col("node").alias("a"), (-F.col("x.hub")).alias("b")), "hubs")
    tested = hub_of
    if parities:
        tested, _, _ = _stored(
            hub_of.join(marks_of("x").withColumnRenamed("node_x", "a"), "a")
            .join(marks_of("y").withColumnRenamed("node_y", "b"), "b")
            .filter(may("x", "y")).select("a", "b"), "tested")
    near, _, _ = _stored(measure(tested), "measured")
    labels, _, _ = _stored(components(near.filter("linked").select("a", "b")), "labels")
    # each node's hub and the most that it is away from it; a node without a hub is its own
    own = hub_of.join(near, ["a", "b"], "left").select(
        F.col("a").alias("node"), F.col("b").alias("hub"), F.coalesce("distance", F.lit(1.0)).alias("distance"))
    rest = shared.select("key", "node", "size").join(own, "node", "left").select(
        "key", "node", "size", F.coalesce("hub", "node").alias("hub"),
        F.coalesce("distance", F.lit(0.0)).alias("distance"))

    def open_buckets(rows: DataFrame) -> tuple[DataFrame, int]:
        """The rows with their component and its place in the bucket (larger components
        later), without buckets of a single component."""
        known = rows.join(labels, "node", "left").withColumn("comp", F.coalesce("root", "node"))
        many = known.groupBy("key").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"),
            F.ceil(F.count("*") / PART).alias("parts")).filter("lo != hi").select("key", "parts")
        known = known.drop("root").join(many, "key")
        place = known.groupBy("key", "comp").agg(F.count("*").alias("place"))
        return _stored(known.join(place, ["key", "comp"]), "open")[:2]

    def earlier(x: str, y: str):
        """Whether y's component comes before x's in their bucket."""
        return (F.col(f"place_{y}") < F.col(f"place_{x}")) | (
            (F.col(f"place_{y}") == F.col(f"place_{x}")) & (F.col(f"comp_{y}") < F.col(f"comp_{x}")))

    def named(rows: DataFrame, side: str, *more: str) -> DataFrame:
        return rows.select("key", *[F.col(c).alias(f"{c}_{side}") for c in
                                    ("node", "size", "comp", "place", *parities, *more)])

    def put_to_test(pairs: DataFrame) -> DataFrame:
        """Measure the pairs that have not been, and join the components that they link."""
        nonlocal tested, near, labels
        a, b = F.greatest("node_x", "node_y"), F.least("node_x", "node_y")
        todo, count, _ = _stored(pairs.select(a.alias("a"), b.alias("b")).filter("a != b")
                                 .distinct().join(tested, ["a", "b"], "left_anti"), "tested")
        if count:
            tested = tested.unionByName(todo)
            got, _, _ = _stored(measure(todo), "measured")
            near = near.unionByName(got)
            links, count, _ = _stored(got.filter("linked").select("a", "b"), "links")
            if count:
                labels = _joined(labels, links)

    rest, n = open_buckets(rest)
    if not n:
        return labels
    if parities:
        # the parities tell all pairs of a bucket apart; hubs would exclude little more
        rest = _stored(rest.drop("size", "hub", "distance").join(marks, "node"), "open")[0]

        def across(rows_x: DataFrame, rows_y: DataFrame) -> DataFrame:
            """Pairs of a bucket across components that sizes and parities leave possible."""
            # a large bucket goes to several tasks, its x dealt out, its y to each
            xs = named(rows_x, "x", "parts").withColumn("part", F.pmod(F.xxhash64("node_x"), "parts_x"))
            ys = named(rows_y, "y", "parts").withColumn("part", F.explode(F.sequence(
                F.lit(0).cast("long"), F.col("parts_y") - 1)))
            return xs.join(ys, ["key", "part"]).filter(earlier("x", "y") & may("x", "y")).select(
                "node_x", "node_y")
    else:
        # the hubs of later components against the nodes of earlier ones: one row per hub of a bucket,
        # with the last component that has it
        hubs = rest.groupBy("key", F.col("hub").alias("node_x")).agg(
            F.max(F.struct("place", "comp")).alias("last"))
        before = F.struct(F.col("place_y").alias("place"), F.col("comp_y").alias("comp")) < F.col("last")
        put_to_test(hubs.join(named(rest, "y"), "key").filter(before).select("node_x", "node_y"))
        rest, n = open_buckets(rest.drop("comp", "place", "parts"))
        if not n:
            return labels
        either = near.select("a", "b", "distance").unionByName(
            near.select(F.col("b").alias("a"), F.col("a").alias("b"), "distance"))
        to_hub = either.unionByName(rest.select(F.col("hub").alias("a"), F.col("hub").alias("b"),
                                                F.lit(0.0).alias("distance")))
        to_hub = to_hub.select(F.col("a").alias("node_y"), F.col("b").alias("hub_x"),
                               F.col("distance").alias("to_hub")).distinct()

        def across(rows_x: DataFrame, rows_y: DataFrame) -> DataFrame:
            """Pairs of a bucket across components that sizes and hub distances leave possible."""
            # y against each hub of its bucket, then against the nodes of that hub
            hub = rows_x.select("key", F.col("hub").alias("hub_x")).distinct()
            ys = named(rows_y, "y").join(hub, "key").join(to_hub, ["node_y", "hub_x"], "left")
            return named(rows_x, "x", "hub", "distance").join(ys, ["key", "hub_x"]).filter(
                earlier("x", "y") & may("x", "y") &
                (F.coalesce("to_hub", F.lit(0.0)) - F.col("distance_x") <= allowed)).select(
                "node_x", "node_y")

    if parities:
        # few turns: the first joins most of what is linked, in buckets of a few nodes all of it
        turn, grow = 8, 2048
    else:
        # as many pairs as the larger side's rows for each node of the smaller ones, at most
        grow = 4
        pairs = across(rest, rest).agg(F.count("*").alias("n")).first()["n"]
        if pairs <= AT_ONCE * n_rows:
            put_to_test(across(rest, rest))
            return labels
    old, (rest, n, _) = rest, _stored(rest.withColumn("turn", F.row_number().over(
        Window.partitionBy("key").orderBy("node"))), "turns")
    if parities:  # else the hubs' distances are read from it
        forget(old)
    lo, last = 1, rest.agg(F.max("turn")).first()[0]
    while n and lo <= last:
        # nodes of earlier turns have met all others
        left, now = rest.filter(F.col("turn") >= lo), F.col("turn") < lo + turn
        put_to_test(across(left, left) if lo + turn > last else
                    across(left, left.filter(now)).unionByName(across(left.filter(now), left)))
        lo, turn = lo + turn, turn * grow
        if lo <= last:
            old, (rest, n) = rest, open_buckets(rest.drop("comp", "place", "parts"))
            if parities:
                forget(old)
    return labels
