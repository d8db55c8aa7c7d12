"""Hypothesis tests (T1-T13): chi-squared goodness of fit and independence,
chi-squared feature selection tests, one-sample Kolmogorov-Smirnov.

Result rows: ``(p_value double, degrees_of_freedom int, statistic double,
method string, null_hypothesis string)``; feature tests add
``feature_index int, feature string``.  Statistics are aggregates over
(category, count) tables; only the p-value — one scalar per result row —
goes through an Arrow UDF (functions/special.py).
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statframe.functions import special
from statframe.functions.columns import apply_null_policy, check, named, not_null
from statframe.functions.columns import features as feature_exprs
from statframe.session import freeze
from statframe.ship import ship

PEARSON = "pearson"
GOODNESS_OF_FIT = "observed follows the same distribution as expected."
INDEPENDENCE = "the occurrence of the outcomes is statistically independent."
KS_ONE_SAMPLE = "Sample follows theoretical distribution"
KS_METHOD = "kolmogorov-smirnov"

log = logging.getLogger("statframe")

MAX_CATEGORIES = 10_000  # distinct labels or values per feature in feature tests
WARN_CATEGORIES = 1_000  # goodness of fit: the approximation degrades beyond this
SCALE_TOLERANCE = 1e-7   # |sum(observed) - sum(expected)| below this: no rescaling

# The statistic of each supported method, given observed and expected Columns.
CHI_SQ_METHODS: dict[str, Callable[[Column, Column], Column]] = {
    PEARSON: lambda o, e: (o - e) * (o - e) / e,
}


def _method(name: str) -> Callable[[Column, Column], Column]:
    if name not in CHI_SQ_METHODS:
        raise ValueError(f"unrecognized method for chi-squared test: {name!r}")
    return CHI_SQ_METHODS[name]


def _term(fn: Callable[[Column, Column], Column], o: Column, e: Column) -> Column:
    """One cell of the statistic; an expectation of 0 divides as floating point does."""
    return F.when(e != 0, fn(o, e)).when(o == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))


def _p_value(stat: Column, dof: Column) -> Column:
    """The chi-squared p-value; NaN of a NaN statistic."""
    return F.when(F.isnan(stat), F.lit(float("nan"))).otherwise(
        special.chi2_sf_udf(stat, dof.cast("double")))


def _finish(df: DataFrame, stat: Column, dof: Column, method: str, h0: str,
            p: Column | None = None, extra: Sequence[Column] = ()) -> DataFrame:
    p_value = _p_value(stat, dof) if p is None else p
    return df.select(*extra, p_value.alias("p_value"), dof.cast("int").alias("degrees_of_freedom"),
                     stat.alias("statistic"), F.lit(method).alias("method"),
                     F.lit(h0).alias("null_hypothesis"))


# ------------------------------------------------------------ goodness of fit

def chisq_gof(observed: DataFrame, expected: DataFrame | None = None,
              category: str = "category", observed_col: str = "observed",
              expected_col: str = "expected", method: str = PEARSON) -> DataFrame:
    """Pearson goodness of fit of observed counts against expected counts or
    frequencies (T1), or against the uniform distribution (T2).

    Tables are keyed by ``category``; the two must list the same categories.
    Expected values are rescaled to the observed total unless the totals
    agree to 1e-7.  An expected 0 (before rescaling) with an observed count
    above 0 gives an infinite statistic and p 0; 0 in both is an error
    (order-free, unlike the reference, where the first offending cell decides).
    Nothing observed against positive expectations is no evidence: statistic and p
    are NaN, as they are with an infinite count.
    """
    fn = _method(method)
    ship(observed.sparkSession)  # before the first use of a Python function
    o = F.col("_o")
    obs = observed.select(not_null(F.col(category), category).alias("_cat"),
                          not_null(F.col(observed_col).cast("double"), observed_col).alias("_o"))
    if expected is None:
        cells = obs.select("_cat", "_o", F.lit(None).cast("double").alias("_e"))
    else:
        exp = expected.select(not_null(F.col(category), category).alias("_cat"),
                              not_null(F.col(expected_col).cast("double"),
                                       expected_col).alias("_e"))
        cells = obs.join(exp, "_cat", "full_outer")
    cells = freeze(cells)  # categories: read by the checks and by the statistic
    if not cells.groupBy("_cat").count().filter("count > 1").isEmpty():
        raise ValueError("a category is listed more than once")
    e = F.col("_e")
    totals = cells.agg(
        F.count(F.lit(1)).alias("size"),
        F.count_if(o.isNull() | e.isNull()).alias("unmatched") if expected is not None
        else F.lit(0).alias("unmatched"),
        F.count_if(~(o >= 0) | F.isnan(o)).alias("bad_obs"),  # NaN sorts above numbers
        F.count_if(~(e >= 0) | F.isnan(e)).alias("bad_exp") if expected is not None else F.lit(0).alias("bad_exp"),
        F.count_if((e == 0) & (o == 0)).alias("zero_zero") if expected is not None
        else F.lit(0).alias("zero_zero"),
        F.sum(o).alias("obs_sum"),
        F.sum(e).alias("exp_sum") if expected is not None else F.lit(1.0).alias("exp_sum"),
    ).collect()[0]  # one row of counters: the scale factor is a scalar
    if totals["unmatched"]:
        raise ValueError("observed and expected must be of the same size")
    if totals["bad_obs"]:
        raise ValueError("negative entries disallowed in the observed vector")
    if totals["bad_exp"]:
        raise ValueError("negative entries disallowed in the expected vector")
    if totals["zero_zero"]:
        raise ValueError("chi-squared statistic undefined for input vectors due to 0.0 "
                         "values in both observed and expected")
    size = totals["size"]
    if size > WARN_CATEGORIES:
        log.warning("chi-squared approximation may not be accurate with %d categories "
                    "(low expected frequencies)", size)
    if size < 2:
        raise ValueError("goodness of fit needs at least two categories (degrees of freedom 0)")
    obs_sum, exp_sum = totals["obs_sum"], totals["exp_sum"]
    # an expected total of 0 leaves only cells that are infinite as they stand
    scale = 1.0 if abs(obs_sum - exp_sum) < SCALE_TOLERANCE or not exp_sum else obs_sum / exp_sum
    e_val = F.lit(1.0 / size) if expected is None else e
    e_scaled = e_val if scale == 1.0 else e_val * F.lit(scale)
    term = _term(fn, o, e_scaled)
    agg = cells.agg(F.count_if(e_val == 0).alias("_inf"),
                    F.sum(F.when(e_val == 0, F.lit(0.0)).otherwise(term)).alias("_stat"))
    stat = F.when(F.col("_inf") > 0, F.lit(float("inf"))).otherwise(F.col("_stat"))
    p = F.when(stat == float("inf"), F.lit(0.0)).otherwise(_p_value(F.col("_stat"), F.lit(size - 1)))
    return _finish(agg, stat, F.lit(size - 1), method, GOODNESS_OF_FIT, p)


# ---------------------------------------------------------------- independence

def _independence(cells: DataFrame, keys: list[str], method: str,
                  check_margins: bool) -> DataFrame:
    """cells: (keys..., _r, _c, _n) with unique (keys, _r, _c).  Missing cells
    count 0; their expected values add to the statistic as T - sum(present e)."""
    fn = _method(method)
    rows = cells.groupBy(*keys, "_r").agg(F.sum("_n").alias("_rs"))
    cols = cells.groupBy(*keys, "_c").agg(F.sum("_n").alias("_cs"))
    tot = cells.groupBy(*keys).agg(F.sum("_n").alias("_t"),
                                   F.count_distinct("_r").alias("_nr"),
                                   F.count_distinct("_c").alias("_nc"))
    j = cells.join(rows, [*keys, "_r"]).join(cols, [*keys, "_c"]).join(tot, keys) if keys else \
        cells.join(rows, ["_r"]).join(cols, ["_c"])
    rs, cs = F.col("_rs"), F.col("_cs")
    if check_margins:
        rs = check(rs != 0, rs, "chi-squared statistic undefined for input matrix due to 0 sum in a row")
        cs = check(cs != 0, cs, "chi-squared statistic undefined for input matrix due to 0 sum in a column")
    if keys:
        t = F.col("_t")
        e = rs * cs / t
        per = j.groupBy(*keys).agg(F.sum(_term(fn, F.col("_n"), e)).alias("_s"),
                                   F.sum(e).alias("_es"), F.first("_t").alias("_t"),
                                   F.first("_nr").alias("_nr"), F.first("_nc").alias("_nc"))
    else:
        t_row = tot.collect()[0]  # three numbers
        t = F.lit(float(t_row["_t"]))
        e = rs * cs / t
        per = j.agg(F.sum(_term(fn, F.col("_n"), e)).alias("_s"), F.sum(e).alias("_es")).select(
            "_s", "_es", t.alias("_t"), F.lit(t_row["_nr"]).alias("_nr"),
            F.lit(t_row["_nc"]).alias("_nc"))
    dof = (F.col("_nr") - 1) * (F.col("_nc") - 1)
    stat = F.when(dof == 0, F.lit(0.0)).otherwise(F.col("_s") + (F.col("_t") - F.col("_es")))
    p = F.when(dof == 0, F.lit(1.0)).otherwise(_p_value(stat, dof))
    return per, stat, dof, p


def chisq_independence(table: DataFrame, row: str = "row", col: str = "col",
                       count: str = "count", method: str = PEARSON) -> DataFrame:
    """Pearson independence test on a contingency table in long form.

    Duplicate (row, col) entries are summed; absent cells are zeros.
    Expected = row total x column total / grand total; df = (r-1)(c-1), and
    df 0 gives statistic 0, p 1.  Negative entries or a zero row/column total
    are errors; a NaN or infinite count gives statistic and p NaN.
    """
    ship(table.sparkSession)
    n = not_null(F.col(count).cast("double"), count)
    n = check(~(n < 0), n, "contingency table cannot contain negative entries")
    cells = freeze(table.select(not_null(F.col(row), row).alias("_r"),
                                not_null(F.col(col), col).alias("_c"), n.alias("_n"))
                   .groupBy("_r", "_c").agg(F.sum("_n").alias("_n")))
    per, stat, dof, p = _independence(cells, [], method, check_margins=True)
    return _finish(per, stat, dof, method, INDEPENDENCE, p)


def _category(df: DataFrame, col: str) -> tuple[str, Column]:
    """A feature's kind and its value as a category: whole numbers exactly, 0.0 and -0.0 as one."""
    kind, x = df.schema[col].dataType, F.col(col)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "long", x.cast("long")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return "double", x.cast("double") + F.lit(0.0)
    return "string", x.cast("string")


def _too_many(df: DataFrame, cap: int) -> int | None:
    """The place of a column with more than ``cap`` distinct values: -1 for the first column, the label;
    0, 1, ... for features, or for the places of one array column.  None: there is no such column.

    Every task keeps the distinct values that it has met, at most ``cap`` of a column, and stops
    reading when there is one more; the sets of all tasks are merged, tasks x columns x cap
    values at the most."""
    wide = len(df.columns) == 2 and df.columns[1] == "_a"

    def columns(b):
        yield -1, b.column(0)
        if wide:
            cells = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            for j in range(cells.shape[1]):
                yield j, pa.array(cells[:, j] + 0.0)
        else:
            yield from enumerate(b.columns[1:])

    def distinct(batches):
        met: dict[int, set] = {}
        for b in batches:
            if not b.num_rows:
                continue
            for j, c in columns(b):
                mine = met.setdefault(j, set())
                mine.update(map(repr, c.unique().to_pylist()))
                if len(mine) > cap:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([j], pa.int32()), pa.array([None], pa.string())], names=["at", "v"])
                    return
        for j, mine in met.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(mine), j), pa.int32()), pa.array(list(mine), pa.string())],
                names=["at", "v"])

    seen = df.mapInArrow(distinct, "at int, v string").groupBy("at").agg(
        F.count_distinct("v").alias("n"), F.max(F.col("v").isNull()).alias("over"))
    got = seen.filter(F.col("over") | (F.col("n") > cap)).agg(F.min("at")).first()  # one number
    return got[0]


def chisq_features(df: DataFrame, label: str, features: Sequence[str] | str,
                   method: str = PEARSON, nulls: str = "error", dim: int | None = None,
                   max_categories: int = MAX_CATEGORIES) -> DataFrame:
    """Independence of every feature from the label, each value a category (T4).

    ``features``: columns, or the name of one array column (width ``dim``, else probed).
    One job for all features: cells are stacked to (feature, value, label),
    counted by a partial/final aggregate, and every feature's contingency
    table is reduced by the same grouped plan.  More than ``max_categories`` distinct
    labels or values of a feature is an error: a first scan keeps the distinct values per task
    and ends as soon as a task has too many, before any cell is shuffled.
    Rows come in feature order.
    """
    ship(df.sparkSession)
    raw = [features] if isinstance(features, str) else list(features)
    df = apply_null_policy(df, [label, *raw], nulls)
    lab = not_null(F.col(label), label)
    if isinstance(features, str):
        d = len(feature_exprs(df, features, dim))
        array = check(F.size(features) == d, F.col(features).cast("array<double>"),
                      f"expected {d} values in {features}")
        stacked = df.select(lab.alias("_c"), F.posexplode(array).alias("feature_index", "_x")).select(
            "_c", "feature_index", F.format_string(f"{features}[%d]", "feature_index").alias(
                "feature"), (not_null(F.col("_x"), features) + F.lit(0.0)).alias("_r"))
    else:
        # values of one kind keep it (cheap to hash); of several kinds they meet as text
        kinds = [_category(df, f) for f in raw]
        common = kinds[0][0] if len({k for k, _ in kinds}) == 1 else "string"
        structs = [F.struct(F.lit(i).alias("feature_index"), F.lit(f).alias("feature"),
                            not_null(x.cast(common), f).alias("_r"))
                   for i, (f, (_, x)) in enumerate(zip(raw, kinds))]
        stacked = df.select(lab.alias("_c"), F.inline(F.array(*structs)))
    over = _too_many(df.select(lab.alias("_l"), *(
        [array.alias("_a")] if isinstance(features, str) else
        [x.alias(f"_f{i}") for i, (_, x) in enumerate(kinds)])), max_categories)
    if over is not None:
        what = f"the label {label!r}" if over < 0 else "feature " + repr(
            f"{features}[{over}]" if isinstance(features, str) else raw[over])
        raise ValueError(f"{what} has more than {max_categories} distinct values")
    # the contingency cells feed the margins, the totals and the statistic: checkpointed, so that
    # they are counted once
    cells = freeze(stacked.groupBy("feature_index", "feature", "_r", "_c").agg(
        F.count(F.lit(1)).cast("double").alias("_n")))
    keys = ["feature_index", "feature"]
    per, stat, dof, p = _independence(cells, keys, method, check_margins=False)
    return _finish(per, stat, dof, method, INDEPENDENCE, p,
                   extra=[F.col("feature_index"), F.col("feature")]).orderBy("feature_index")


# ---------------------------------------------------------- Kolmogorov-Smirnov

def ks_test(df: DataFrame, col: str, cdf: Callable[[Column], Column] | str = "norm",
            *params: float, nulls: str = "error") -> DataFrame:
    """One-sample, two-sided Kolmogorov-Smirnov test.

    ``cdf`` is a Column -> Column function (any expression of the value), or
    ``"norm"`` with no parameters (standard normal) or exactly (mean, sd).
    D = max over rows of |i/n - F| and |(i+1)/n - F| in value order.  The values are
    range-partitioned once; a partition needs no more than the rows before it for its true
    positions, so it gives three numbers (rows, largest F - i/n, largest (i+1)/n - F, with i counted
    from its own start), and the rows before it shift both at the merge.  Tasks send equal
    values of a batch on as one row with their count, so a value that holds a third of all rows is a
    few rows a task; between the first and the last row of a tie neither extreme can lie.
    """
    if isinstance(cdf, str):
        if cdf != "norm":
            raise ValueError(f"{cdf!r} not supported; current options are ['norm']")
        if params and len(params) != 2:
            raise ValueError("normal distribution requires mean and standard deviation")
        if not params:
            log.info("no parameters for the normal distribution: using N(0, 1)")
        mu, sigma = (params if params else (0.0, 1.0))
        cdf_fn = lambda x: special.norm_cdf_col(x, mu, sigma)
    else:
        cdf_fn = cdf
    ship(df.sparkSession)
    df = apply_null_policy(df, [col], nulls)
    v = not_null(named(df, col).cast("double"), col)
    x = df.select(check(~F.isnan(v), v, f"NaN in {col}: ranks of NaN are undefined").alias("v"))
    size = df.count()
    if not size:
        raise ValueError("Kolmogorov-Smirnov test needs at least one value")
    ranged = x.mapInArrow(_tied, "v double, c long").repartitionByRange("v").sortWithinPartitions("v")
    parts = ranged.select(cdf_fn(F.col("v")).cast("double").alias("f"), "c").mapInArrow(
        _extremes(size), "part int, rows long, above double, below double")
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0.0).alias("d"))
    n = F.lit(float(size))

    def shift(a, p):
        return F.struct((a.at + p.rows).alias("at"), F.greatest(
            a.d, p.above - a.at / n, p.below + a.at / n).alias("d"))

    # as many entries as partitions
    order = F.array_sort(F.collect_list(F.struct("part", "rows", "above", "below")))
    agg = parts.agg(F.aggregate(order, zero, shift).alias("_a"))
    stat = F.col("_a.d")
    return agg.select(special.ks_pvalue_udf(stat, F.lit(size).cast("long")).alias("p_value"),
                      F.lit(0).alias("degrees_of_freedom"), stat.alias("statistic"),
                      F.lit(KS_METHOD).alias("method"),
                      F.lit(KS_ONE_SAMPLE).alias("null_hypothesis"))


def _tied(batches):
    """Each batch's distinct values and how often it has them."""
    for b in batches:
        v, c = np.unique(b.column(0).to_numpy(zero_copy_only=False), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(c.astype(np.int64))], names=["v", "c"])


def _extremes(size: int):
    """A range partition's rows, and how far F gets from their places within the partition."""
    def run(batches):
        rows, above, below = 0, -np.inf, -np.inf
        for b in batches:
            if not b.num_rows:
                continue
            if b.column("f").null_count:
                raise ValueError("the distribution function gave a null")
            f, c = b.column("f").to_numpy(), b.column("c").to_numpy()
            last = rows + np.cumsum(c)
            above = np.maximum(above, (f - (last - c) / size).max())
            below = np.maximum(below, (last / size - f).max())
            rows = int(last[-1])
        if rows:
            part = TaskContext.get().partitionId()  # range partitions are numbered in order
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([rows], pa.int64()), pa.array([float(above)]),
                 pa.array([float(below)])], names=["part", "rows", "above", "below"])
    return run


# ------------------------------------------------------------------ result text

def explain(results: DataFrame) -> DataFrame:
    """Add ``presumption`` and ``summary`` text columns to test results."""
    p = F.col("p_value")
    h0 = F.col("null_hypothesis")
    level = (F.when(p <= 0.01, F.lit("Very strong"))
             .when(p <= 0.05, F.lit("Strong"))
             .when(p <= 0.1, F.lit("Low"))
             .otherwise(F.lit("No")))
    # the text appends "." even to a hypothesis that already ends with one
    presumption = F.concat(level, F.lit(" presumption against null hypothesis: "), h0, F.lit("."))
    method = F.col("method")
    head = (F.when(method == KS_METHOD, F.lit("Kolmogorov-Smirnov test summary:\n"))
            .when(method.isin(*CHI_SQ_METHODS), F.concat(
                F.lit("Chi squared test summary:\nmethod: "), method, F.lit("\n")))
            .otherwise(F.concat(F.lit("Streaming test summary:\nmethod: "), method, F.lit("\n"))))
    summary = F.concat(head, F.lit("degrees of freedom = "),
                       F.col("degrees_of_freedom").cast("string"),
                       F.lit(" \nstatistic = "), F.col("statistic").cast("string"),
                       F.lit(" \npValue = "), p.cast("string"), F.lit(" \n"), presumption)
    return results.withColumn("presumption", presumption).withColumn("summary", summary)
