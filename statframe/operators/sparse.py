"""Covariance, correlation and feature tests of sparse vectors in long form.

Cells ``(row, feature, value)``; an absent cell is 0 and no zero is ever made.

* Cross products: sum x_i x_j only has terms where a row stores both cells, so each row is
  multiplied out by itself, the rows of an Arrow batch together: what leaves a task are sums per pair
  and chunk of rows, not products.  A row with more than ``split`` cells is cut into blocks of about that
  many, and each pair of blocks is one record, dealt by (row, block, block): a row that holds a third
  of all cells is many records in many tasks.  Zeros come back by algebra:
  cov_ij = (sum x_i x_j - s_i s_j / n) / (n - 1).
* Feature tests: the count of value 0 per (feature, label) is the label's rows less its stored cells.

The covariance and correlation tables hold the pairs of features that some row stores together,
feature_i <= feature_j.  Any other pair has cross product 0; ``SparseCross.cov_at`` gives the
covariance of whatever pairs are asked for.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statframe.functions.columns import check, not_null
from statframe.operators import hypothesis as H
from statframe.operators.correlation import NEAR_ZERO
from statframe.session import freeze
from statframe.ship import ship

SPLIT = 512  # cells of a row that are multiplied out in one record
BROADCAST_FEATURES = 1 << 16  # asked features that every task may hold


@dataclass
class SparseCross:
    """What covariance and correlation need: ``n`` rows, ``sums (feature, s)`` and
    ``cross (feature_i, feature_j, value)`` of the pairs that occur, feature_i <= feature_j."""

    n: int
    sums: DataFrame
    cross: DataFrame

    def _with_cov(self, pairs: DataFrame) -> DataFrame:
        if self.n < 2:
            raise ValueError("covariance needs more than one row")
        si = self.sums.select(F.col("feature").alias("feature_i"), F.col("s").alias("_si"))
        sj = self.sums.select(F.col("feature").alias("feature_j"), F.col("s").alias("_sj"))
        cov = (F.col("value") - F.col("_si") * F.col("_sj") / F.lit(float(self.n))) / F.lit(
            float(self.n - 1))
        return pairs.join(si, "feature_i").join(sj, "feature_j").select(
            "feature_i", "feature_j", cov.alias("cov"))

    def cov(self) -> DataFrame:
        """(feature_i, feature_j, cov) of every pair that some row stores together."""
        return self._with_cov(self.cross)

    def cov_at(self, pairs: DataFrame) -> DataFrame:
        """The covariance of given pairs (feature_i, feature_j), whether they occur together or
        not.  Pairs of unknown features are left out: a feature without a cell is constant."""
        low, high = F.least("feature_i", "feature_j"), F.greatest("feature_i", "feature_j")
        asked = pairs.select(low.alias("feature_i"), high.alias("feature_j")).distinct()
        found = asked.join(self.cross, ["feature_i", "feature_j"], "left").withColumn(
            "value", F.coalesce("value", F.lit(0.0)))
        return self._with_cov(found)

    def corr(self) -> DataFrame:
        """(feature_i, feature_j, corr) with the rules of the dense form: a variance of at most
        1e-12 counts as 0 and gives NaN, the diagonal is always 1."""
        cov = self.cov()
        var = cov.filter("feature_i = feature_j").select(F.col("feature_i").alias("_f"), F.when(
            F.abs("cov") <= NEAR_ZERO, F.lit(0.0)).otherwise(F.sqrt("cov")).alias("_sd"))
        both = cov.join(var.select(F.col("_f").alias("feature_i"), F.col("_sd").alias("_di")),
                        "feature_i").join(
            var.select(F.col("_f").alias("feature_j"), F.col("_sd").alias("_dj")), "feature_j")
        r = (F.when(F.col("feature_i") == F.col("feature_j"), F.lit(1.0))
             .when((F.col("_di") == 0) | (F.col("_dj") == 0), F.lit(float("nan")))
             .otherwise(F.col("cov") / (F.col("_di") * F.col("_dj"))))
        return both.select("feature_i", "feature_j", r.alias("corr"))


def _stored_cells(cells: DataFrame, row: str, feature: str, value: str) -> DataFrame:
    """(_r, _f, _x) of the cells that are not 0; nulls are errors."""
    x = not_null(F.col(f"`{value}`").cast("double"), value)
    return cells.select(not_null(F.col(f"`{row}`"), row).alias("_r"),
                        not_null(F.col(f"`{feature}`"), feature).alias("_f"), x.alias("_x")).filter(
        F.col("_x") != 0)


DENSE_WIDTH = 1024    # features of a chunk up to which it may be multiplied as a matrix
DENSE_GAIN = 256      # multiply-adds of a matrix product that cost as much as one listed pair
CHUNK_CELLS, CHUNK_PAIRS = 1 << 19, 1 << 21  # cells and listed pairs that a chunk of records holds


def _chunks(cells: np.ndarray, pairs: np.ndarray):
    """Ranges of records of a bounded number of cells and pairs, a record at least."""
    start, c, p = 0, 0, 0
    for i in range(len(cells)):
        if i > start and (c + cells[i] > CHUNK_CELLS or p + pairs[i] > CHUNK_PAIRS * DENSE_GAIN):
            yield start, i
            start, c, p = i, 0, 0
        c, p = c + cells[i], p + pairs[i]
    if start < len(cells):
        yield start, len(cells)


def _listed(lf, lx, rf, rx, first, count, width):
    """(i, j, value) of the pairs of each left cell with ``count`` right cells from ``first`` on, equal
    pairs added up, a bounded number of pairs at a time."""
    ends = np.cumsum(count)
    cuts = np.searchsorted(ends, np.arange(CHUNK_PAIRS, ends[-1] + CHUNK_PAIRS, CHUNK_PAIRS), "left") + 1
    for lo, hi in zip([0, *cuts[:-1]], cuts):
        n = count[lo:hi]
        if not n.sum():
            continue
        left = np.repeat(np.arange(lo, lo + len(n)), n)
        right = np.arange(len(left)) + np.repeat(first[lo:hi] - (np.cumsum(n) - n), n)
        pair, at = np.unique(lf[left] * width + rf[right], return_inverse=True)
        yield *np.divmod(pair, width), np.bincount(at, lx[left] * rx[right])


def _multiply(batches):
    """Partial sums (a, b, value) over records of cells ``_c`` by cells ``_d``; a record without
    ``_d`` gives all pairs of its own cells, each with itself too.

    The records of a chunk are one matrix product where the chunk's features are few for its cells; else
    its pairs are listed and added up.  Both give only pairs that some record holds."""
    for batch in batches:
        sides = [batch.column("_c"), batch.column("_d")]
        sizes = [np.asarray(pc.fill_null(pc.list_value_length(s), 0)).astype(np.int64) for s in sides]
        inside = np.asarray(pc.is_null(sides[1]))
        pairs = np.where(inside, sizes[0] * (sizes[0] + 1) // 2, sizes[0] * sizes[1])
        # the records that meet themselves and those that meet others are chunks of their own
        for kind in (True, False):
            mine = np.flatnonzero(inside == kind)
            for lo, hi in _chunks((sizes[0] + sizes[1])[mine], pairs[mine]):
                take = pa.array(mine[lo:hi])
                left = sides[0].take(take)
                right = left if kind else sides[1].take(take)
                both = [pc.list_flatten(left)] + ([] if kind else [pc.list_flatten(right)])
                coded = pa.concat_arrays([pc.struct_field(c, "_f") for c in both]).dictionary_encode()
                code = coded.indices.to_numpy().astype(np.int64)
                lx, rx = (pc.struct_field(c, "_x").to_numpy() for c in (both[0], both[-1]))
                lf, rf = code[:len(lx)], code[len(code) - len(rx):]
                ln, rn = sizes[0][mine[lo:hi]], sizes[0 if kind else 1][mine[lo:hi]]
                lr, rr = (np.repeat(np.arange(hi - lo), n) for n in (ln, rn))
                width, total = len(coded.dictionary), int(pairs[mine[lo:hi]].sum())
                if not total:
                    continue
                # what is not finite would turn absent cells into NaN
                if (width <= DENSE_WIDTH and (hi - lo) * width * width <= DENSE_GAIN * total
                        and np.isfinite(lx).all() and np.isfinite(rx).all()):
                    got = _matrix(lr, lf, lx, rr, rf, rx, hi - lo, width, kind)
                else:
                    ends = np.cumsum(rn)
                    first = np.arange(len(lx)) if kind else (ends - rn)[lr]
                    got = _listed(lf, lx, rf, rx, first, ends[lr] - first, width)
                for i, j, v in got:
                    yield pa.RecordBatch.from_arrays(
                        [coded.dictionary.take(pa.array(i)), coded.dictionary.take(pa.array(j)),
                         pa.array(v)], names=["a", "b", "value"])


def _matrix(lr, lf, lx, rr, rf, rx, rows, width, inside):
    """``_listed`` by matrix products, a bounded number of rows at a time."""
    total, met = np.zeros((width, width)), np.zeros((width, width))
    step = max(1, (1 << 21) // width)
    for lo in range(0, rows, step):
        def side(r, f, x):
            at = slice(*np.searchsorted(r, [lo, lo + step]))
            m, h = np.zeros((min(step, rows - lo), width)), np.zeros((min(step, rows - lo), width))
            m[r[at] - lo, f[at]], h[r[at] - lo, f[at]] = x[at], 1
            return m, h

        m, h = side(lr, lf, lx)
        n, g = (m, h) if inside else side(rr, rf, rx)
        total += m.T @ n
        met += h.T @ g
    i, j = np.nonzero(np.triu(met) if inside else met)
    yield i, j, total[i, j]


def cross_products(cells: DataFrame, row: str = "row_id", feature: str = "feature",
                   value: str = "value", num_rows: int | None = None, min_rows: int = 1,
                   split: int = SPLIT) -> SparseCross:
    """The cross products of sparse rows.  ``num_rows`` counts all rows, those without a cell too;
    by default the rows that have one.  Features that fewer than ``min_rows`` rows store are not
    asked about: the number of pairs grows with the square of a row's cells.  A feature twice in a
    row is an error."""
    ship(cells.sparkSession)
    x = _stored_cells(cells, row, feature, value)
    if min_rows > 1:
        some = freeze(x.groupBy("_f").agg(F.count(F.lit(1)).alias("n")).filter(
            F.col("n") >= min_rows).select("_f"))
        # few features are sent to the cells, which stay where they are
        few = some.count() <= BROADCAST_FEATURES
        x = x.join(F.broadcast(some) if few else some, "_f", "left_semi")
    x = freeze(x)
    if num_rows is None:
        num_rows = cells.select(F.count_distinct(F.col(f"`{row}`"))).first()[0]  # one number
    parts = x.groupBy("_r").agg(F.ceil(F.count(F.lit(1)) / F.lit(split)).alias("_parts"))
    # rows meet once, by _r; their blocks are groups within that partitioning
    cell = F.struct("_f", "_x")
    blocks = x.join(parts, "_r").withColumn("_b", F.pmod(F.xxhash64("_f"), "_parts")).groupBy(
        "_r", "_b").agg(F.first("_parts").alias("_parts"), F.collect_list(cell).alias("_c"))
    once = F.size(F.array_distinct(F.transform("_c", lambda c: c._f))) == F.size("_c")
    blocks = freeze(blocks.withColumn("_c", check(once, F.col("_c"), "a row stores a feature twice")))
    heavy = blocks.filter("_parts > 1")
    left = heavy.filter(F.col("_b") < F.col("_parts") - 1).select(
        "_r", F.col("_b").alias("_p"), "_c",
        F.explode(F.sequence(F.col("_b") + 1, F.col("_parts") - 1)).alias("_q"))
    right = heavy.filter(F.col("_b") > 0).select(
        "_r", F.col("_b").alias("_q"), F.col("_c").alias("_d"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_b") - 1)).alias("_p"))
    within = blocks.select("_c", F.lit(None).cast(blocks.schema["_c"].dataType).alias("_d"))
    across = left.join(right, ["_r", "_p", "_q"]).select("_c", "_d")
    kind = x.schema["_f"].dataType.simpleString()
    sums_of = f"a {kind}, b {kind}, value double"
    partial = within.mapInArrow(_multiply, sums_of).unionByName(across.mapInArrow(_multiply, sums_of))
    cross = partial.groupBy(F.least("a", "b").alias("feature_i"), F.greatest("a", "b").alias(
        "feature_j")).agg(F.sum("value").alias("value"))
    sums = x.groupBy(F.col("_f").alias("feature")).agg(F.sum("_x").alias("s"))
    return SparseCross(int(num_rows), freeze(sums), freeze(cross))


def cov_sparse(cells: DataFrame, row: str = "row_id", feature: str = "feature",
               value: str = "value", num_rows: int | None = None, min_rows: int = 1,
               split: int = SPLIT) -> DataFrame:
    """Sample covariance of sparse features (C8): (feature_i, feature_j, cov) of the pairs that some
    row stores together."""
    return cross_products(cells, row, feature, value, num_rows, min_rows, split).cov()


def corr_sparse(cells: DataFrame, row: str = "row_id", feature: str = "feature",
                value: str = "value", num_rows: int | None = None, min_rows: int = 1,
               split: int = SPLIT) -> DataFrame:
    """Pearson correlation of sparse features (C1): (feature_i, feature_j, corr)."""
    return cross_products(cells, row, feature, value, num_rows, min_rows, split).corr()


def chisq_features_sparse(cells: DataFrame, rows: DataFrame, row: str = "row_id",
                          feature: str = "feature", value: str = "value", label: str = "label",
                          method: str = H.PEARSON, max_categories: int = H.MAX_CATEGORIES
                          ) -> DataFrame:
    """Independence of every sparse feature from the label (T4): one row per feature that a labelled
    row stores, with the result columns of ``chisq_features`` and ``feature``.

    ``rows`` holds (row, label) of all rows, those without a cell too; cells of other rows are
    left out.  Each value is a category, 0 among them: its count for a label is the label's
    rows less the stored cells.  ``rows`` may not repeat a row, nor a row a feature.  More than
    ``max_categories`` labels, or values of a feature, is an error.
    """
    ship(cells.sparkSession)
    labelled = rows.select(not_null(F.col(f"`{row}`"), row).alias("_r"),
                           not_null(F.col(f"`{label}`"), label).alias("_c"))
    # as many rows as labels, bounded by the cap
    totals = [(r["_c"], r["n"]) for r in labelled.groupBy("_c").agg(
        F.count(F.lit(1)).alias("n")).limit(max_categories + 1).collect()]
    if not totals:
        raise ValueError("feature tests need at least one labelled row")
    if len(totals) > max_categories:
        raise ValueError(f"the label {label!r} has more than {max_categories} distinct values")
    n = float(sum(t for _, t in totals))
    x = _stored_cells(cells, row, feature, value)
    counted = freeze(x.join(labelled, "_r").groupBy("_f", F.col("_x").alias("_v"), "_c").agg(
        F.count(F.lit(1)).alias("_n")))
    stored = counted.groupBy("_f", "_v").agg(F.sum("_n").alias("_row"))
    zeros = stored.groupBy("_f").agg((F.lit(n).cast("long") - F.sum("_row")).alias("_row"),
                                     F.count(F.lit(1)).alias("_kinds"))
    most = zeros.select("_f", (F.col("_kinds") + (F.col("_row") > 0).cast("int")).alias("_kinds"))
    wide = most.filter(F.col("_kinds") > max_categories).limit(1).collect()
    if wide:
        raise ValueError(f"feature {wide[0]['_f']!r} has {wide[0]['_kinds']} distinct values; "
                         f"at most {max_categories} are allowed")
    left = check(F.col("_row") >= 0, F.col("_row"), "a row is listed twice, or stores a feature twice")
    values = stored.unionByName(zeros.select("_f", F.lit(0.0).alias("_v"), left.alias("_row")).filter(
        "_row > 0"))
    # every value of a feature with each label: as many rows as stored values x labels
    kind = labelled.schema["_c"].dataType
    every = F.explode(F.array(*[F.struct(F.lit(c).cast(kind).alias("_c"), F.lit(t).alias("_t"))
                                for c, t in totals])).alias("_l")
    grid = values.select("*", every).select("_f", "_v", "_row", "_l._c", "_l._t")
    held = counted.groupBy("_f", "_c").agg(F.sum("_n").alias("_n")).select(
        "_f", F.lit(0.0).alias("_v"), "_c", "_n")
    table = grid.join(counted.unionByName(held), ["_f", "_v", "_c"], "left")
    seen = F.coalesce(F.col("_n"), F.lit(0))
    o = F.when(F.col("_v") == 0, F.col("_t") - seen).otherwise(seen).cast("double")
    e = F.col("_row") * F.col("_t") / F.lit(n)
    per = table.groupBy(F.col("_f").alias("feature")).agg(
        F.sum(H._method(method)(o, e)).alias("_s"), F.count_distinct("_v").alias("_nr"))
    dof = (F.col("_nr") - 1) * F.lit(len(totals) - 1)
    stat = F.when(dof == 0, F.lit(0.0)).otherwise(F.col("_s"))
    p = F.when(dof == 0, F.lit(1.0)).otherwise(H._p_value(stat, dof))
    return H._finish(per, stat, dof, method, H.INDEPENDENCE, p, extra=[F.col("feature")])


def top_pairs(table: DataFrame, value: str = "corr", k: int = 100,
              order: Callable[[str], Column] = F.abs) -> DataFrame:
    """The ``k`` pairs of different features with the largest |value|: a report on a sparse
    correlation table, taken by a top-k per partition."""
    strength = order(value)
    return table.filter((F.col("feature_i") != F.col("feature_j")) & ~F.isnan(value)).orderBy(
        strength.desc(), "feature_i", "feature_j").limit(k)
