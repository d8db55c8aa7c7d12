"""Naive Bayes, multinomial and Bernoulli.

Training is one grouped aggregate per label (and per feature in the sparse
form): pi_c = ln(n_c + l) - ln(N + C l); theta_cj = ln(S_cj + l) - ln(S_c + D l)
(multinomial) or - ln(n_c + 2 l) (Bernoulli), with l the additive smoothing.

The model is two tables: ``prior (label, pi)`` and ``cond (label, feature,
theta)``; ``cond`` is complete (every label x feature), because unseen cells
carry the smoothing term.  Labels are kept ascending and are small (the
number of classes), so they live on the driver; the tables stay DataFrames.

Scoring:

* dense input (feature columns or one array column): score_c = pi_c + sum_j
  theta_cj x_j is a projection without a shuffle: literal coefficients for a
  model of a few dozen cells, one matrix product per Arrow batch for any
  larger one;
* sparse input ``(row, feature, value)``: join the nonzero cells with one
  array of C coefficients per feature, one grouped sum per row.  Rows without
  any known feature still score their prior.

Multinomial models score any values, negative ones too, as the reference
does; only training asks for nonnegative values.

Argmax takes the first maximum in label order; posteriors subtract the
maximum before ``exp``.  With smoothing 0 a feature count of 0 adds 0 (the
product 0 * -inf is never formed), a documented deviation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statframe.functions.columns import apply_null_policy, check, features, not_null
from statframe.session import freeze
from statframe.ship import ship

MULTINOMIAL = "multinomial"
BERNOULLI = "bernoulli"
MODEL_TYPES = (MULTINOMIAL, BERNOULLI)
LITERAL_MAX = 64      # model cells carried as literals in a projection
MAX_CLASSES = 10_000  # default bound on distinct labels: a label column is not an id

NEG_INF = float("-inf")


def safe_ln(c: Column) -> Column:
    """ln with ln(0) = -Infinity (Spark's ln(0) is NULL)."""
    return F.when(c == 0, F.lit(NEG_INF)).otherwise(F.ln(c))


@dataclass
class NaiveBayesModel:
    labels: list
    model_type: str
    smoothing: float
    num_features: int
    prior: DataFrame                       # (label, pi)
    cond: DataFrame                        # (label, feature, theta)
    feature_names: list[str] | None = None  # dense training columns, in order
    _pi: list[float] | None = field(default=None, repr=False)

    @property
    def num_classes(self) -> int:
        return len(self.labels)

    def pi_values(self) -> list[float]:
        if self._pi is None:
            rows = {r["label"]: r["pi"] for r in self.prior.collect()}  # C rows
            self._pi = [rows[lab] for lab in self.labels]
        return self._pi

    def describe(self) -> str:
        return (f"NaiveBayesModel(type={self.model_type}, classes={self.num_classes}, "
                f"features={self.num_features}, smoothing={self.smoothing})")


def label_order(value):
    """Sort key of a label as Spark orders them (NaN after every number):
    the C label rows are sorted on the driver, no distributed sort needed."""
    if isinstance(value, float) and math.isnan(value):
        return (1, 0.0)
    return (0, value)


def _check_params(model_type: str, smoothing: float):
    if model_type not in MODEL_TYPES:
        raise ValueError(f"model type {model_type!r} is not supported; use one of {MODEL_TYPES}")
    if not smoothing >= 0:
        raise ValueError(f"smoothing must be nonnegative, got {smoothing}")


def _value_check(x: Column, name: str, model_type: str) -> Column:
    x = not_null(x, name)
    if model_type == BERNOULLI:
        return check((x == 0) | (x == 1), x,
                     f"Bernoulli naive Bayes requires 0 or 1 feature values ({name})")
    # NaN sorts above every number in Spark, so it is rejected explicitly
    return check((x >= 0) & ~F.isnan(x), x,
                 f"naive Bayes requires nonnegative feature values ({name})")


def _classes(labels_counts: list, max_classes: int) -> list:
    if not labels_counts:
        raise ValueError("naive Bayes needs at least one labelled row")
    if len(labels_counts) > max_classes:
        raise ValueError(f"more than {max_classes} distinct labels")
    return labels_counts


def _build(labels_counts: list, sums: DataFrame, num_features: int, model_type: str,
           smoothing: float, feature_names=None) -> NaiveBayesModel:
    """labels_counts: [(label, n_c)] ascending; sums: complete (label, feature, s)."""
    spark = sums.sparkSession
    lam = float(smoothing)
    n_total = sum(n for _, n in labels_counts)
    num_labels = len(labels_counts)
    pi_denom = math.log(n_total + num_labels * lam)
    labels = [lab for lab, _ in labels_counts]
    pis = [(lab, (math.log(n + lam) if n + lam > 0 else NEG_INF) - pi_denom)
           for lab, n in labels_counts]
    label_type = sums.schema["label"].dataType.simpleString()
    prior = spark.createDataFrame(pis, f"label {label_type}, pi double")
    if model_type == MULTINOMIAL:
        tot = sums.groupBy("label").agg(F.sum("s").alias("_st"))
        denom = safe_ln(F.col("_st") + F.lit(num_features * lam))
        cond = sums.join(tot, "label")
    else:
        counts = spark.createDataFrame([(lab, float(n)) for lab, n in labels_counts],
                                       f"label {label_type}, _nc double")
        denom = safe_ln(F.col("_nc") + F.lit(2.0 * lam))
        cond = sums.join(counts, "label")
    cond = cond.select("label", "feature",
                       (safe_ln(F.col("s") + F.lit(lam)) - denom).alias("theta"))
    return NaiveBayesModel(labels, model_type, lam, num_features, prior, cond, feature_names,
                           [p for _, p in pis])


def fit(df: DataFrame, label: str, cols: Sequence[str] | str, model_type: str = MULTINOMIAL,
        smoothing: float = 1.0, nulls: str = "error", dim: int | None = None,
        max_classes: int = MAX_CLASSES) -> NaiveBayesModel:
    """Train on dense rows: a label column and feature columns, or the name of one array
    column (width ``dim``, else probed) (N1, N2).

    One pass: per label, the row count and the sum of every feature — a
    partial/final aggregate with C x D outputs — then pi and theta.
    """
    _check_params(model_type, smoothing)
    if isinstance(cols, str):
        return _fit_array(df, label, cols, model_type, smoothing, nulls, dim, max_classes)
    cols = list(cols)
    df = apply_null_policy(df, [label, *cols], nulls)
    xs = [_value_check(F.col(c).cast("double"), c, model_type).alias(f"_x{j}")
          for j, c in enumerate(cols)]
    data = df.select(not_null(F.col(label), label).alias("label"), *xs)
    agg = data.groupBy("label").agg(F.count(F.lit(1)).alias("_n"),
                                    *[F.sum(f"_x{j}").alias(f"_s{j}") for j in range(len(cols))])
    # C rows of D sums: the size of the model itself
    rows = sorted(agg.limit(max_classes + 1).collect(), key=lambda r: label_order(r["label"]))
    labels_counts = _classes([(r["label"], r["_n"]) for r in rows], max_classes)
    label_type = data.schema["label"].dataType.simpleString()
    sums = df.sparkSession.createDataFrame(
        [(r["label"], j, float(r[f"_s{j}"])) for r in rows for j in range(len(cols))],
        f"label {label_type}, feature int, s double")
    return _build(labels_counts, sums, len(cols), model_type, smoothing, cols)


def _fit_array(df, label, col, model_type, smoothing, nulls, dim, max_classes):
    """The sums of an array column's places stay a table: C x D rows, never on the driver."""
    df = apply_null_policy(df, [label, col], nulls)
    d = len(features(df, col, dim))
    array = check(F.size(col) == d, not_null(F.col(col).cast("array<double>"), col),
                  f"expected {d} values in {col}")
    cells = df.select(not_null(F.col(label), label).alias("label"),
                      F.posexplode(array).alias("feature", "_x"))
    sums = freeze(cells.groupBy("label", "feature").agg(
        F.sum(_value_check(F.col("_x"), col, model_type)).alias("s"), F.count("*").alias("_n")))
    # every row has all places, so any place's cells count the rows
    rows = sums.filter("feature = 0").select("label", "_n").limit(max_classes + 1).collect()
    labels_counts = _classes(sorted(((r["label"], r["_n"]) for r in rows),
                                    key=lambda r: label_order(r[0])), max_classes)
    model = _build(labels_counts, sums.drop("_n"), d, model_type, smoothing,
                   [f"{col}[{j}]" for j in range(d)])
    model.cond = freeze(model.cond)
    return model


def fit_sparse(cells: DataFrame, row_labels: DataFrame, row: str = "row_id",
               feature: str = "feature", value: str = "value", label: str = "label",
               model_type: str = MULTINOMIAL, smoothing: float = 1.0,
               num_features: int | None = None, max_classes: int = MAX_CLASSES
               ) -> NaiveBayesModel:
    """Train on sparse rows: cells ``(row, feature, value)`` and ``(row, label)``.

    The feature space is the features seen in labelled rows (or
    ``0 .. num_features-1`` when features are integer indexes and a size is
    given — an index outside is an error); absent cells are zeros.  ``cond`` is completed by exploding the
    C labels over the feature list — model-sized, no data-sized product.
    """
    _check_params(model_type, smoothing)
    x = _value_check(F.col(value).cast("double"), value, model_type)
    lab = row_labels.select(F.col(row).alias("_row"), not_null(F.col(label), label).alias("label"))
    known = F.col(feature)
    if num_features is not None:
        known = check((known >= 0) & (known < num_features), known,
                      f"a feature index lies outside 0..{num_features - 1}")
    cc = cells.select(F.col(row).alias("_row"), known.alias("feature"), x.alias("_x"))
    joined = cc.join(lab, "_row")
    # the sufficient statistics are the model (C x features rows): materialised
    # once in the shared checkpoint folder, so scoring does not re-read the data
    sums = freeze(joined.groupBy("label", "feature").agg(F.sum("_x").alias("s")))
    counts = lab.groupBy("label").agg(F.count(F.lit(1)).alias("_n")).limit(max_classes + 1)
    labels_counts = _classes(sorted(((r["label"], r["_n"]) for r in counts.collect()),
                                    key=lambda r: label_order(r[0])), max_classes)
    spark = cells.sparkSession
    if num_features is not None:
        vocab = spark.range(num_features).select(F.col("id").cast("int").alias("feature"))
        d = num_features
    else:
        vocab = sums.select("feature").distinct()
        d = vocab.count()
    label_type = lab.schema["label"].dataType.simpleString()
    label_arr = F.array(*[F.lit(lv).cast(label_type) for lv, _ in labels_counts])
    grid = vocab.select("feature", F.explode(label_arr).alias("label"))
    full = grid.join(sums, ["label", "feature"], "left").select(
        "label", "feature", F.coalesce(F.col("s"), F.lit(0.0)).alias("s"))
    model = _build(labels_counts, full, int(d), model_type, smoothing)
    # the completed table is the model (labels x features) and is read by every
    # scoring pass and the Bernoulli constants: materialise it once
    model.cond = freeze(model.cond)
    return model


# ------------------------------------------------------------------ scoring

def _score_terms(model: NaiveBayesModel
                 ) -> tuple[list[list[float]], list[float], list[list[bool]]]:
    """Per class: coefficients on x, the constant (pi, plus the Bernoulli sum), and the features
    without which the class is impossible."""
    rows = model.cond.collect()  # C x D cells: the model, which every task carries
    idx = {lab: i for i, lab in enumerate(model.labels)}
    theta = [[0.0] * model.num_features for _ in model.labels]
    for r in rows:
        theta[idx[r["label"]]][int(r["feature"])] = r["theta"]
    consts = list(model.pi_values())
    always = [[False] * model.num_features for _ in model.labels]
    if model.model_type == BERNOULLI:
        coef = []
        for i, th in enumerate(theta):
            # a feature on in every row of a class: its absence rules the class out
            always[i] = [not t < 0 for t in th]
            neg = [math.log(1 - math.exp(t)) if t < 0 else 0.0 for t in th]
            consts[i] += sum(neg)
            coef.append([t - n for t, n in zip(th, neg)])
        return coef, consts, always
    return theta, consts, always


def _score_udf(coef: list[list[float]], consts: list[float], always: list[list[bool]]):
    """All class scores of a feature array, by one matrix product per batch."""
    theta, const = np.array(coef, dtype=np.float64), np.array(consts, dtype=np.float64)
    must = np.array(always, dtype=np.float64)
    never = np.isinf(theta)
    finite = np.where(never, 0.0, theta)

    @F.pandas_udf("array<double>")
    def scores(x: pd.Series) -> pd.Series:
        if any(v is None or len(v) != theta.shape[1] for v in x):
            raise ValueError(f"every feature array must have {theta.shape[1]} values")
        if not len(x):
            return pd.Series([], dtype=object)
        a = np.stack(x.tolist()).astype(np.float64)
        out = a @ finite.T + const
        if never.any():  # a value on a place of probability 0; a value of 0 adds nothing
            out = np.where((a > 0) @ never.T, NEG_INF, out)
            out = np.where((a < 0) @ never.T, -NEG_INF, out)
        if must.any():  # a value of 0 on a place that is always on
            out = np.where((a == 0) @ must.T > 0, NEG_INF, out)
        return pd.Series(list(out))

    return scores


def _dense_scores(model: NaiveBayesModel, df: DataFrame, cols: Sequence[str] | str | None
                  ) -> tuple[DataFrame, list[Column]]:
    """``df`` with checked features and per-class scores as columns.

    Three stacked projections (checked x, scores, then the caller's use) so
    each feature check and each score is evaluated once per row, not once
    per class or per posterior.
    """
    cols = cols or model.feature_names
    array = isinstance(cols, str)
    if not array and len(list(cols)) != model.num_features:
        raise ValueError(f"expected {model.num_features} feature columns, got {len(list(cols))}")
    coef, consts, always = _score_terms(model)

    def checked_value(x: Column, name: str) -> Column:
        return _value_check(x, name, BERNOULLI) if model.model_type == BERNOULLI \
            else not_null(x, name)

    if array or model.num_classes * model.num_features > LITERAL_MAX:
        ship(df.sparkSession)
        if array:
            x = F.transform(F.col(cols).cast("array<double>"), lambda v: checked_value(v, cols))
        else:
            x = F.array(*[checked_value(F.col(c).cast("double"), c) for c in cols])
        scored = df.select("*", _score_udf(coef, consts, always)(x).alias("_nbs"))
        return scored, [F.col("_nbs")[i] for i in range(model.num_classes)]
    cols = list(cols)
    checked = df.select("*", *[checked_value(F.col(c).cast("double"), c)
                               .alias(f"_nbx{j}") for j, c in enumerate(cols)])
    xs = [F.col(f"_nbx{j}") for j in range(len(cols))]
    scores = []
    for i in range(model.num_classes):
        s = F.lit(consts[i])
        for j, x in enumerate(xs):
            t = coef[i][j]
            if always[i][j]:
                s = s + F.when(x != 0, x * F.lit(t)).otherwise(F.lit(NEG_INF))
            elif math.isfinite(t):
                s = s + x * F.lit(t)
            else:
                s = s + F.when(x != 0, x * F.lit(t)).otherwise(F.lit(0.0))
        scores.append(s.alias(f"_nbs{i}"))
    scored = checked.select(*df.columns, *scores)
    return scored, [F.col(f"_nbs{i}") for i in range(model.num_classes)]


def _argmax(model: NaiveBayesModel, scores: list[Column]) -> Column:
    m = F.greatest(*scores) if len(scores) > 1 else scores[0]
    out = None
    for lab, s in zip(model.labels, scores):
        out = F.when(s == m, F.lit(lab)) if out is None else out.when(s == m, F.lit(lab))
    return out


def _posteriors(scores: list[Column]) -> list[Column]:
    m = F.greatest(*scores) if len(scores) > 1 else scores[0]
    ex = [F.exp(s - m) for s in scores]
    total = ex[0]
    for e in ex[1:]:
        total = total + e
    return [e / total for e in ex]


def predict(model: NaiveBayesModel, df: DataFrame, cols: Sequence[str] | str | None = None,
            output: str = "prediction") -> DataFrame:
    """``df`` plus the predicted label (N3, N4): a projection."""
    scored, scores = _dense_scores(model, df, cols)
    return scored.select(*df.columns, _argmax(model, scores).alias(output))


def predict_proba(model: NaiveBayesModel, df: DataFrame,
                  cols: Sequence[str] | str | None = None,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Long posteriors ``(keep..., label, probability)``."""
    scored, scores = _dense_scores(model, df, cols)
    post = scored.select(*keep, *[p.alias(f"_nbp{i}") for i, p in enumerate(_posteriors(scores))])
    structs = [F.struct(F.lit(lab).alias("label"), F.col(f"_nbp{i}").alias("probability"))
               for i, lab in enumerate(model.labels)]
    return post.select(*keep, F.inline(F.array(*structs)))


def _coefficients(model: NaiveBayesModel) -> tuple[list[float], list[int], DataFrame]:
    """Per class the constant and the number of features that it must have; and the table (label,
    _f, _coef, _must) of what each cell adds."""
    theta = F.col("theta")
    consts, musts = list(model.pi_values()), [0] * model.num_classes
    coef, must = theta, F.lit(0)
    if model.model_type == BERNOULLI:
        neg = F.when(theta < 0, F.log1p(-F.exp(theta))).otherwise(F.lit(0.0))
        # a feature on in every row of a class: its absence rules the class out
        coef, must = theta - neg, F.when(theta < 0, F.lit(0)).otherwise(F.lit(1))
        per = {r["label"]: r for r in model.cond.groupBy("label").agg(
            F.sum(neg).alias("ns"), F.sum(must).alias("m")).collect()}  # C rows
        consts = [c + per[lab]["ns"] for c, lab in zip(consts, model.labels)]
        musts = [per[lab]["m"] for lab in model.labels]
    return consts, musts, model.cond.select("label", F.col("feature").alias("_f"),
                                            coef.alias("_coef"), must.alias("_must"))


def _sparse_scores(model: NaiveBayesModel, cells: DataFrame, rows: DataFrame, row: str,
                   feature: str, value: str) -> DataFrame:
    """Wide per-row scores ``(row, _s0 .. _s{C-1})`` for sparse input."""
    consts, musts, table = _coefficients(model)
    # one row per feature with its coefficient of every class
    places = range(model.num_classes)
    strict = [i for i in places if musts[i]]

    def of(i, name):
        return F.max(F.when(F.col("label").eqNullSafe(F.lit(model.labels[i])), F.col(name)))

    cond = table.groupBy("_f").agg(*[of(i, "_coef").alias(f"_c{i}") for i in places],
                                   *[of(i, "_must").alias(f"_m{i}") for i in strict])
    x = F.col(value).cast("double")
    x = _value_check(x, value, BERNOULLI) if model.model_type == BERNOULLI else not_null(x, value)
    cc = cells.select(F.col(row).alias("_row"), F.col(feature).alias("_f"), x.alias("_x")) \
        .filter(F.col("_x") != 0)
    contrib = cc.join(cond, "_f").select("_row", *[
        (F.col("_x") * F.col(f"_c{i}")).alias(f"_s{i}") for i in places],
        *[F.col(f"_m{i}") for i in strict])
    base = rows.select(F.col(row).alias("_row"), *[F.lit(0.0).alias(f"_s{i}") for i in places],
                       *[F.lit(0).alias(f"_m{i}") for i in strict])
    # rows asked for, each once: cells of other rows score nothing
    sums = contrib.withColumn("_asked", F.lit(False)).unionByName(
        base.withColumn("_asked", F.lit(True))).groupBy("_row").agg(
        F.max("_asked").alias("_asked"), *[F.sum(f"_s{i}").alias(f"_s{i}") for i in places],
        *[F.sum(f"_m{i}").alias(f"_m{i}") for i in strict])

    def score(i):
        s = F.lit(consts[i]) + F.col(f"_s{i}")
        return F.when(F.col(f"_m{i}") < musts[i], F.lit(NEG_INF)).otherwise(s) if i in strict else s

    return sums.filter("_asked").select(F.col("_row").alias(row), *[
        score(i).alias(f"_s{i}") for i in places])


def predict_sparse(model: NaiveBayesModel, cells: DataFrame, rows: DataFrame,
                   row: str = "row_id", feature: str = "feature", value: str = "value",
                   output: str = "prediction", with_probability: bool = False) -> DataFrame:
    """``(row, prediction[, probability])`` for every row of ``rows``; unknown
    features are ignored.  ``probability`` is the posterior of the prediction."""
    wide = _sparse_scores(model, cells, rows, row, feature, value)
    scores = [F.col(f"_s{i}") for i in range(model.num_classes)]
    cols = [F.col(row), _argmax(model, scores).alias(output)]
    if with_probability:
        m = F.greatest(*scores) if len(scores) > 1 else scores[0]
        total = None
        for s_ in scores:
            total = F.exp(s_ - m) if total is None else total + F.exp(s_ - m)
        cols.append((F.lit(1.0) / total).alias("probability"))
    return wide.select(*cols)


def predict_proba_sparse(model: NaiveBayesModel, cells: DataFrame, rows: DataFrame,
                         row: str = "row_id", feature: str = "feature",
                         value: str = "value") -> DataFrame:
    """Long posteriors ``(row, label, probability)`` for sparse input."""
    wide = _sparse_scores(model, cells, rows, row, feature, value)
    scores = [F.col(f"_s{i}") for i in range(model.num_classes)]
    post = _posteriors(scores)
    structs = [F.struct(F.lit(lab).alias("label"), p.alias("probability"))
               for lab, p in zip(model.labels, post)]
    return wide.select(row, F.inline(F.array(*structs)))


# --------------------------------------------------- scoring with models of any size

FEATURES_PER_BLOCK, CLASSES_PER_BLOCK, CELLS_PER_BLOCK = 1 << 12, 64, 1 << 16
PRODUCTS_HELD = 1 << 22  # partial products that a task adds up before they leave it


def dense_cells(df: DataFrame, key: str, cols: Sequence[str] | str, dim: int | None = None
                ) -> DataFrame:
    """The nonzero cells (key, feature, value) of dense rows, for the functions below."""
    feats = features(df, cols, dim)
    if isinstance(cols, str):
        array = check(F.size(cols) == len(feats), not_null(F.col(cols).cast("array<double>"), cols),
                      f"expected {len(feats)} values in {cols}")
        cells = df.select(F.col(key), F.posexplode(array).alias("feature", "value"))
    else:
        cells = df.select(F.col(key), F.inline(F.array(*[F.struct(
            F.lit(j).alias("feature"), e.alias("value")) for j, (_, e) in enumerate(feats)])))
    return cells.select(key, "feature", not_null(F.col("value"), "a feature").alias("value")).filter(
        "value != 0")


def _scored_blocked(model: NaiveBayesModel, cells: DataFrame, rows: DataFrame, row: str = "row_id",
                    feature: str = "feature", value: str = "value",
                    features_per_block: int = FEATURES_PER_BLOCK,
                    classes_per_block: int = CLASSES_PER_BLOCK,
                    cells_per_block: int = CELLS_PER_BLOCK, keep: Sequence[str] = ()) -> DataFrame:
    """``rows`` as (_row, _kept, _copies, _labels, _scores): ``keep`` as a struct, how often the row
    is listed, and its scores in the order of the labels.

    The model is cut into blocks of features x classes, each task's cells into blocks of a bounded
    number and by the features of the model's blocks; blocks meet on their features, each pair is
    multiplied in a task, and the partial products are summed per row.  No task and no driver holds
    more of the model than a block, a model no larger than that is sent to the cells; a feature that
    most rows store is spread over the cells' blocks.  Rows, and what is left of their cells' products,
    are shuffled once, by row.
    """
    spark = cells.sparkSession
    ship(spark)
    consts, musts, table = _coefficients(model)
    kind = model.prior.schema["label"].dataType.simpleString()
    # C rows
    places = spark.createDataFrame([(lab, i) for i, lab in enumerate(model.labels)],
                                   f"label {kind}, place int")
    x = not_null(F.col(value).cast("double"), value)
    x = _value_check(x, value, BERNOULLI) if model.model_type == BERNOULLI else x
    nf = max(1, -(-model.num_features // features_per_block))
    fb = F.pmod(F.xxhash64("_f"), F.lit(nf)).alias("fb")
    cc = cells.select(F.col(row).alias("_row"), F.col(feature).alias("_f"), x.alias("_x")).filter(
        F.col("_x") != 0).select("_row", "_f", "_x", fb)
    parts = table.join(places, table.label.eqNullSafe(places.label)).select(
        "_f", (F.col("place") / classes_per_block).cast("int").alias("cb"), "place", "_coef", "_must"
    ).groupBy(fb, "cb").agg(F.collect_list(F.struct("_f", "place", "_coef", "_must")).alias("model"))
    if model.num_features * model.num_classes <= FEATURES_PER_BLOCK * CLASSES_PER_BLOCK:
        parts = F.broadcast(parts)
    row_kind, f_kind = (cc.schema[c].dataType.simpleString() for c in ("_row", "_f"))
    demanding = any(musts)

    def cut(batches):
        import pyarrow as pa

        def blocks(held, seen):
            t = pa.Table.from_batches(held).combine_chunks()
            for lo in range(0, len(t), cells_per_block):
                part = t.slice(lo, cells_per_block)
                of = part.column("fb").to_numpy()
                part = part.take(pa.array(np.argsort(of, kind="stable"))).combine_chunks()
                ids, n = np.unique(of, return_counts=True)
                flat = pa.StructArray.from_arrays(
                    [part.column(c).combine_chunks() if part.column(c).num_chunks != 1 else
                     part.column(c).chunk(0) for c in ("_row", "_f", "_x")], names=["_row", "_f", "_x"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), seen), pa.int64()), pa.array(ids, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), flat)],
                    names=["block", "fb", "cells"])
                seen += 1

        seen, held, n = TaskContext.get().partitionId() << 32, [], 0
        for b in batches:
            if b.num_rows:
                held, n = [*held, b], n + b.num_rows
            if n >= cells_per_block:
                yield from blocks(held, seen)
                seen, held, n = seen + -(-n // cells_per_block), [], 0
        if held:
            yield from blocks(held, seen)

    def multiply(batches):
        import pyarrow as pa

        def product(c, m):
            """The rows of cells ``c``, the classes of the block ``m``, and their scores."""
            mf = m.field("_f")
            f = pa.concat_arrays([mf, c.field("_f").cast(mf.type)]).dictionary_encode()
            at = f.indices.to_numpy()
            mf, cf = at[:len(m)], at[len(m):]
            known = cf <= mf.max()
            c, cf = c.filter(pa.array(known)), cf[known]
            if not len(c):
                return None
            used, pos = np.unique(m.field("place").to_numpy(), return_inverse=True)
            coef, must = np.zeros((2, mf.max() + 1, len(used)))
            coef[mf, pos] = m.field("_coef").to_numpy()
            must[mf, pos] = m.field("_must").to_numpy()
            r = c.field("_row").dictionary_encode()
            at, v = r.indices.to_numpy(), c.field("_x").to_numpy()[:, None]
            order = np.argsort(at, kind="stable")
            starts = np.searchsorted(at[order], np.arange(len(r.dictionary)))
            return (r.dictionary, used, np.add.reduceat((v * coef[cf])[order], starts, axis=0),
                    np.add.reduceat(must[cf][order], starts, axis=0) if demanding else None)

        def summed(held):
            """One record per row and run of classes."""
            r = pa.concat_arrays([h[0] for h in held]).dictionary_encode()
            codes = np.split(r.indices.to_numpy(), np.cumsum([len(h[0]) for h in held])[:-1])
            used = np.unique(np.concatenate([h[1] for h in held]))
            score, had = np.zeros((2, len(r.dictionary), len(used)))
            for (_, own, s, m), code in zip(held, codes):
                at = np.ix_(code, np.searchsorted(used, own))
                score[at] += s
                if demanding:
                    had[at] += m
            n = len(r.dictionary)
            for run in np.split(np.arange(len(used)), np.flatnonzero(np.diff(used) != 1) + 1):
                ends = pa.array(np.arange(n + 1) * len(run), pa.int32())
                s, m = (pa.ListArray.from_arrays(ends, pa.array(x[:, run].reshape(-1)))
                        for x in (score, had))
                yield pa.RecordBatch.from_arrays(
                    [r.dictionary, pa.array(np.full(n, used[run[0]]), pa.int32()), s,
                     m if demanding else pa.nulls(n, m.type)], names=["_row", "place", "s", "m"])

        key, held, size = None, [], 0
        for b in batches:
            for i in range(b.num_rows):
                block = b.column("block")[i].as_py()
                if held and (block != key or size > PRODUCTS_HELD):
                    yield from summed(held)
                    held, size = [], 0
                key = block
                got = product(b.column("cells")[i].values, b.column("model")[i].values)
                if got:
                    held.append(got)
                    size += got[2].size
        if held:
            yield from summed(held)

    cut_cells = cc.mapInArrow(cut, f"block long, fb long, cells array<struct<_row: {row_kind}, "
                                   f"_f: {f_kind}, _x: double>>")
    products = cut_cells.join(parts, "fb").select("block", "cells", "model").mapInArrow(
        multiply, f"_row {row_kind}, place int, s array<double>, m array<double>")
    # dealt by row before they are collected: the cells of a row are mostly in one task by then
    sums = products.filter("_row IS NOT NULL").repartition("_row").groupBy("_row").agg(
        F.collect_list(F.struct("place", "s", "m")).alias("_parts"))
    asked = rows.select(F.col(row).alias("_row"), F.struct(F.lit(0).alias("_"), *[F.col(c) for c in keep])
                        .alias("_kept"))
    classes = spark.createDataFrame(
        [(list(model.labels), [float(c) for c in consts], [float(m) for m in musts])],
        f"_labels array<{kind}>, _consts array<double>, _musts array<double>")

    def total(part: str) -> Column:
        zeros = F.array_repeat(F.lit(0.0), model.num_classes)
        return F.coalesce(F.aggregate("_parts", zeros, lambda acc, p: F.transform(
            acc, lambda v, i: v + F.coalesce(F.when(i >= p.place, F.get(p[part], i - p.place)),
                                             F.lit(0.0)))), zeros)

    scores = F.transform(total("s"), lambda v, i: F.get("_consts", i) + v)
    if demanding:
        scores = F.zip_with(scores, F.zip_with(total("m"), "_musts", lambda h, m: h < m),
                            lambda v, out: F.when(out, F.lit(NEG_INF)).otherwise(v))
    copies = F.count(F.lit(1)).over(Window.partitionBy("_row"))
    return asked.join(sums, "_row", "left").withColumn("_copies", copies).crossJoin(
        F.broadcast(classes)).select("_row", "_kept", "_copies", "_labels", scores.alias("_scores"))


def scores_blocked(model: NaiveBayesModel, cells: DataFrame, rows: DataFrame,
                   row: str = "row_id", feature: str = "feature", value: str = "value",
                   features_per_block: int = FEATURES_PER_BLOCK,
                   classes_per_block: int = CLASSES_PER_BLOCK,
                   cells_per_block: int = CELLS_PER_BLOCK) -> DataFrame:
    """(row, label, place, score) of every row and class by a blocked matrix product."""
    s = _scored_blocked(model, cells, rows, row, feature, value, features_per_block,
                        classes_per_block, cells_per_block)
    return s.select(F.col("_row").alias(row), F.posexplode(F.arrays_zip(
        F.col("_labels").alias("label"), F.col("_scores").alias("score"))).alias("place", "_x")).select(
        row, "_x.label", "place", "_x.score")


def predict_proba_blocked(model: NaiveBayesModel, cells: DataFrame, rows: DataFrame,
                          row: str = "row_id", keep: Sequence[str] = (), **options) -> DataFrame:
    """Posteriors (row, keep..., label, probability) of models of any size: softmax over a row's
    classes.  ``keep``: columns of ``rows`` to hand on."""
    s = _scored_blocked(model, cells, rows, row, keep=keep, **options)
    s = s.withColumn("_max", F.array_max("_scores")).withColumn(
        "_e", F.transform("_scores", lambda v: F.exp(v - F.col("_max"))))
    whole = F.aggregate("_e", F.lit(0.0), lambda a, v: a + v) * F.col("_copies")
    s = s.withColumn("_sum", whole)
    return s.select(F.col("_row").alias(row), *[F.col("_kept")[c].alias(c) for c in keep], F.inline(
        F.arrays_zip(F.col("_labels").alias("label"), F.transform(
            "_e", lambda v: v / F.col("_sum")).alias("probability"))))


def predict_blocked(model: NaiveBayesModel, cells: DataFrame, rows: DataFrame,
                    row: str = "row_id", output: str = "prediction", **options) -> DataFrame:
    """(row, prediction) with models of any size: the first label of the largest score."""
    s = _scored_blocked(model, cells, rows, row, **options)
    best = F.array_max(F.transform("_scores", lambda v, i: F.struct(v.alias("v"), (-i).alias("i"))))
    return s.select("_row", F.get("_labels", -best["i"]).alias("_best")).groupBy(
        F.col("_row").alias(row)).agg(F.first("_best").alias(output))


# ------------------------------------------------------------------ additive counts

def count_table(df: DataFrame, label: str, cols: Sequence[str] | str, model_type: str = MULTINOMIAL,
                by: Sequence[str] = (), nulls: str = "error", dim: int | None = None) -> DataFrame:
    """What training needs of dense rows, per slice ``by``: (by..., label, feature, s, n).  A row with
    feature null counts the label's rows, the others sum its features; tables add up
    (``add_counts``) and slices can be taken out again (``remove_counts``)."""
    _check_params(model_type, 1.0)
    raw = [cols] if isinstance(cols, str) else list(cols)
    df = apply_null_policy(df, [label, *raw], nulls)
    feats = features(df, cols, dim)
    cells = [F.struct(F.lit(None).cast("int").alias("feature"), F.lit(0.0).alias("x"))]
    cells += [F.struct(F.lit(j).alias("feature"), _value_check(e, n, model_type).alias("x"))
              for j, (n, e) in enumerate(feats)]
    long = df.select(*[F.col(b) for b in by], not_null(F.col(label), label).alias("label"),
                     F.inline(F.array(*cells)))
    return long.groupBy(*by, "label", "feature").agg(F.sum("x").alias("s"),
                                                     F.count(F.lit(1)).alias("n"))


def add_counts(table: DataFrame, *more: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The counts of several tables, or of all slices of one, rolled up to ``by``."""
    for t in more:
        table = table.unionByName(t, allowMissingColumns=True)
    return table.groupBy(*by, "label", "feature").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))


def remove_counts(table: DataFrame, *gone: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``table`` without the rows counted in ``gone``; more than there are is an error."""
    for t in gone:
        table = table.unionByName(t.withColumn("s", -F.col("s")).withColumn("n", -F.col("n")),
                                  allowMissingColumns=True)
    left = add_counts(table, by=by)
    n = check(F.col("n") >= 0, F.col("n"), "more rows are taken out than were counted")
    return left.withColumn("n", n).filter("n > 0")


def fit_counts(table: DataFrame, model_type: str = MULTINOMIAL, smoothing: float = 1.0,
               feature_names: Sequence[str] | None = None, max_classes: int = MAX_CLASSES
               ) -> NaiveBayesModel:
    """The model of a count table, the same as ``fit`` on the rows that it counts."""
    _check_params(model_type, smoothing)
    table = freeze(add_counts(table))
    rows = table.filter("feature IS NULL AND n > 0").select("label", "n").limit(max_classes + 1).collect()
    labels_counts = _classes(sorted(((r["label"], r["n"]) for r in rows),
                                    key=lambda r: label_order(r[0])), max_classes)
    sums = table.filter("feature IS NOT NULL AND n > 0").select("label", "feature", "s")
    d = sums.select(F.count_distinct("feature")).first()[0]  # one number
    return _build(labels_counts, sums, d, model_type, smoothing,
                  list(feature_names) if feature_names else None)
