"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over
the given tables, rounded for comparison (functions/rounding.py).  The
matching DuckDB texts live in ``statframe.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statframe.functions.rounding import rounded, rounded_matrix
from statframe.functions import text as TX
from statframe.operators import bayes as NB
from statframe.operators import correlation as C
from statframe.operators import gaussian as G
from statframe.operators import hypothesis as H
from statframe.operators import linear as LR
from statframe.operators import rank as R
from statframe.operators import sparse as SP
from statframe.operators import sparse_linear as SL
from statframe.operators import summary as S
from statframe.operators import zipped as ZP
from statframe.session import freeze, scratch_path, table, written
from statframe.sources import models as MD
from statframe.streaming import abtest as AB
from statframe.streaming import online as ON
from statframe.streaming import summary as SS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

LINEITEM_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def query(fn):
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


# ---------------------------------------------------------------- summaries

@query
def q_col_summary(spark, sf):
    li = table(spark, sf, "lineitem")
    return rounded(S.col_summary(li, LINEITEM_NUM))


@query
def q_col_summary_weighted(spark, sf):
    li = table(spark, sf, "lineitem")
    return rounded(S.col_summary(li, ["l_extendedprice", "l_discount", "l_tax"],
                                 weight="l_quantity"))


@query
def q_col_summary_weighted_grouped(spark, sf):
    """Weighted by quantity, per return flag (two passes joined on the flag)."""
    li = table(spark, sf, "lineitem")
    return rounded(S.col_summary(li, ["l_extendedprice", "l_discount"], weight="l_quantity",
                                 group_by=["l_returnflag"]))


@query
def q_col_summary_grouped(spark, sf):
    ev = table(spark, sf, "events")
    return rounded(S.col_summary(ev, ["value"], group_by=["event_type"]))


@query
def q_summary_rollup(spark, sf):
    """States per (flag, status, ship year) rolled up to the flag."""
    li = table(spark, sf, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    state = S.summary_state(li, LINEITEM_NUM,
                            group_by=["l_returnflag", "l_linestatus", "ship_year"])
    merged = S.merge_states(state, ["l_returnflag"])
    return rounded(S.finalize(merged, ["l_returnflag"]))


@query
def q_col_summary_embeddings(spark, sf):
    """All 64 embedding coordinates (the per-task numpy state path)."""
    emb = table(spark, sf, "embeddings")
    return rounded(S.col_summary(emb, "embedding", dim=64))


@query
def q_sparse_summary(spark, sf):
    """Orders as sparse vectors: cell l_linenumber holds the discount total of
    that line number; orders without lines are all-zero rows."""
    li = table(spark, sf, "lineitem")
    cells = (li.groupBy(F.col("l_orderkey").alias("row_id"), F.col("l_linenumber").alias("idx"))
             .agg(F.sum("l_discount").alias("value")))
    return rounded(S.sparse_summary(cells, num_rows=table(spark, sf, "orders")
                                    .agg(F.count(F.lit(1)).alias("_rows"))))


# -------------------------------------------------------------- correlation

@query
def q_cov_matrix(spark, sf):
    return rounded(C.cov_matrix(table(spark, sf, "lineitem"), LINEITEM_NUM))


@query
def q_corr_pearson_matrix(spark, sf):
    return rounded(C.corr(table(spark, sf, "lineitem"), LINEITEM_NUM, "pearson"))


@query
def q_corr_pearson_pair(spark, sf):
    return rounded(C.corr_pair(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"))


@query
def q_corr_from_cov(spark, sf):
    """Covariance of customer balance, key and nation, normalised."""
    cu = table(spark, sf, "customer")
    cov = C.cov_matrix(cu, ["c_acctbal", "c_custkey", "c_nationkey"])
    return rounded(C.corr_from_cov(cov))


@query
def q_corr_zipped(spark, sf):
    """Quantities and prices, written apart in one order and in different numbers of files."""
    li = table(spark, sf, "lineitem")
    order = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    x = li.repartitionByRange(3, *order).sortWithinPartitions(*order).select("l_quantity")
    y = li.repartitionByRange(8, *order).sortWithinPartitions(*order).select("l_extendedprice")
    return rounded(ZP.corr_zipped(x, y, "l_quantity", "l_extendedprice"))


@query
def q_corr_spearman_matrix(spark, sf):
    return rounded(C.corr(table(spark, sf, "lineitem"), LINEITEM_NUM, "spearman"))


@query
def q_corr_spearman_long(spark, sf):
    """Spearman through the long-form plan: cells joined once with all rank
    tables and regrouped per (generated, checkpointed) row id."""
    return rounded(C.spearman(table(spark, sf, "lineitem"), LINEITEM_NUM, long_form=True))


@query
def q_corr_spearman_pair(spark, sf):
    return rounded(C.corr_pair(table(spark, sf, "lineitem"), "l_discount", "l_tax", "spearman"))


@query
def q_avg_rank(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                              "l_extendedprice", "l_discount")
    return rounded(R.avg_rank(li, ["l_extendedprice", "l_discount"]))


# ---------------------------------------------------------- hypothesis tests

# The assumed event mix the goodness-of-fit query tests against.
EVENT_MIX = [("view", 0.30), ("click", 0.25), ("purchase", 0.15), ("signup", 0.10),
             ("error", 0.20)]


def _feature_test(spark, sf):
    li = table(spark, sf, "lineitem")
    return H.chisq_features(li, "l_linestatus", ["l_returnflag", "l_tax", "l_discount"])


@query
def q_chisq_gof(spark, sf):
    ev = table(spark, sf, "events")
    observed = ev.groupBy(F.col("event_type").alias("category")).agg(
        F.count(F.lit(1)).alias("observed"))
    expected = spark.createDataFrame(EVENT_MIX, "category string, expected double")
    return rounded(H.chisq_gof(observed, expected))


@query
def q_chisq_gof_uniform(spark, sf):
    part = table(spark, sf, "part")
    observed = part.groupBy(F.col("p_brand").alias("category")).agg(
        F.count(F.lit(1)).alias("observed"))
    return rounded(H.chisq_gof(observed))


@query
def q_chisq_independence(spark, sf):
    li = table(spark, sf, "lineitem")
    counts = li.groupBy(F.col("l_returnflag").alias("row"), F.col("l_linestatus").alias("col")
                        ).agg(F.count(F.lit(1)).alias("count"))
    return rounded(H.chisq_independence(counts))


@query
def q_chisq_features(spark, sf):
    return rounded(_feature_test(spark, sf))


@query
def q_test_explain(spark, sf):
    res = H.explain(_feature_test(spark, sf)).drop("summary")
    return rounded(res)


@query
def q_ks_expon(spark, sf):
    """events.value against the exponential distribution with mean 50."""
    ev = table(spark, sf, "events")
    return rounded(H.ks_test(ev, "value", lambda x: 1 - F.exp(-x / 50.0)))


@query
def q_ks_norm(spark, sf):
    ev = table(spark, sf, "events")
    return rounded(H.ks_test(ev, "value", "norm", 50.0, 50.0))


@query
def q_ks_std_norm(spark, sf):
    """First embedding coordinate, scaled by 8, against N(0, 1)."""
    emb = table(spark, sf, "embeddings").select(
        (F.col("embedding")[0].cast("double") * 8.0).alias("z"))
    return rounded(H.ks_test(emb, "z"))


@query
def q_ks_small_sample(spark, sf):
    """supplier.s_acctbal against U(-1000, 10000): the exact p-value of a small sample."""
    return rounded(H.ks_test(table(spark, sf, "supplier"), "s_acctbal",
                             lambda x: (x + 1000.0) / 11000.0))


@query
def q_ks_middling(spark, sf):
    """customer.c_acctbal against U(-1000, 10000): a p-value that is neither 0 nor 1."""
    return rounded(H.ks_test(table(spark, sf, "customer"), "c_acctbal",
                             lambda x: (x + 1000.0) / 11000.0))


# ---------------------------------------------------------------- naive Bayes

NB_COUNT_FEATURES = ["f_qty", "f_disc", "f_tax"]


def _nb_rows(spark, sf, bernoulli: bool):
    li = table(spark, sf, "lineitem")
    if bernoulli:
        feats = [(F.col("l_quantity") > 25).cast("double").alias("f_qty"),
                 (F.col("l_discount") > 0.05).cast("double").alias("f_disc"),
                 (F.col("l_tax") > 0.04).cast("double").alias("f_tax")]
    else:
        feats = [F.col("l_quantity").alias("f_qty"),
                 F.round(F.col("l_discount") * 100).alias("f_disc"),
                 F.round(F.col("l_tax") * 100).alias("f_tax")]
    return li.select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate", *feats)


def _nb_model(spark, sf, model_type):
    rows = _nb_rows(spark, sf, model_type == NB.BERNOULLI)
    return rows, NB.fit(rows, "l_returnflag", NB_COUNT_FEATURES, model_type)


def _nb_table(model):
    return model.cond.join(model.prior, "label").select("label", "feature", "pi", "theta")


@query
def q_nb_multinomial_fit(spark, sf):
    return rounded(_nb_table(_nb_model(spark, sf, NB.MULTINOMIAL)[1]))


@query
def q_nb_bernoulli_fit(spark, sf):
    return rounded(_nb_table(_nb_model(spark, sf, NB.BERNOULLI)[1]))


@query
def q_nb_multinomial_predict(spark, sf):
    rows, model = _nb_model(spark, sf, NB.MULTINOMIAL)
    return NB.predict(model, rows).select("l_orderkey", "l_linenumber", "prediction")


@query
def q_nb_bernoulli_predict(spark, sf):
    rows, model = _nb_model(spark, sf, NB.BERNOULLI)
    return NB.predict(model, rows).select("l_orderkey", "l_linenumber", "prediction")


@query
def q_nb_posterior(spark, sf):
    rows, model = _nb_model(spark, sf, NB.MULTINOMIAL)
    return rounded(NB.predict_proba(model, rows, keep=["l_orderkey", "l_linenumber"]))


@query
def q_nb_doc_quality(spark, sf):
    """Multinomial naive Bayes on document term counts, trained on the
    labelled documents' quality flag, scoring every document."""
    docs = table(spark, sf, "documents")
    # term counts feed both training and scoring: tokenise the corpus once
    cells = freeze(TX.term_counts(docs, "doc_id", "text"))
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    model = NB.fit_sparse(cells, labels, row="doc_id", feature="term", value="tf")
    return rounded(NB.predict_sparse(model, cells, docs, row="doc_id", feature="term",
                                     value="tf", with_probability=True))


@query
def q_nb_bernoulli_doc(spark, sf):
    """Bernoulli naive Bayes on term presence: the toxic flag of labelled
    documents, scoring every document (absent terms count through the
    per-class sum of ln(1 - p))."""
    docs = table(spark, sf, "documents")
    cells = freeze(TX.term_presence(TX.term_counts(docs, "doc_id", "text")))
    labels = table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = NB.fit_sparse(cells, labels, row="doc_id", feature="term", value="tf",
                          model_type=NB.BERNOULLI)
    return rounded(NB.predict_sparse(model, cells, docs, row="doc_id", feature="term",
                                     value="tf", with_probability=True))


# ---------------------------------------------------------- linear regression

LR_FEATURES = ["x_qty", "x_disc", "x_tax"]
LR_RAW = ["l_quantity", "l_discount", "l_tax"]


def _lr_rows(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                     (F.col("l_extendedprice") / 10000).alias("y"),
                     (F.col("l_quantity") / 10).alias("x_qty"),
                     (F.col("l_discount") * 10).alias("x_disc"),
                     (F.col("l_tax") * 10).alias("x_tax"))


def _lr_intercept_model(spark, sf):
    rows = _lr_rows(spark, sf)
    return rows, LR.train_sgd(rows, "y", LR_FEATURES, num_iterations=100, step_size=0.1,
                              intercept=True)


@query
def q_linreg_sgd(spark, sf):
    m = LR.train_sgd(_lr_rows(spark, sf), "y", LR_FEATURES, num_iterations=100, step_size=0.1)
    return rounded(m.coefficients(spark))


@query
def q_linreg_sgd_w0(spark, sf):
    m = LR.train_sgd(_lr_rows(spark, sf), "y", LR_FEATURES, num_iterations=50, step_size=0.1,
                     initial_weights=[1.0, 0.0, 0.0])
    return rounded(m.coefficients(spark))


@query
def q_linreg_sgd_intercept(spark, sf):
    return rounded(_lr_intercept_model(spark, sf)[1].coefficients(spark))


@query
def q_linreg_sgd_scaled(spark, sf):
    m = LR.train_sgd(_lr_rows(spark, sf), "y", LR_RAW, num_iterations=100, step_size=0.1,
                     intercept=True, feature_scaling=True)
    return rounded(m.coefficients(spark))


@query
def q_linreg_minibatch(spark, sf):
    """Half of the rows per iteration: buckets of the row key, a different
    permutation of buckets each iteration."""
    m = LR.train_sgd(_lr_rows(spark, sf), "y", LR_FEATURES, num_iterations=100, step_size=0.1,
                     intercept=True, mini_batch_fraction=0.5,
                     sample_key=F.col("l_orderkey") * 16 + F.col("l_linenumber"))
    return rounded(m.coefficients(spark))


@query
def q_linreg_predict(spark, sf):
    rows, m = _lr_intercept_model(spark, sf)
    return rounded(m.predict(rows).select("l_orderkey", "l_linenumber", "prediction"))


@query
def q_linreg_mse(spark, sf):
    rows, m = _lr_intercept_model(spark, sf)
    return rounded(LR.mse(m, rows, "y"))


# ---------------------------------------------------------- Gaussian scoring

# The Gaussian the scoring queries evaluate.
MVN_A, MVN_B = 0.014, 0.0015  # sigma = a I + b 11', a full 64 x 64 matrix
CHI2_64DF_99 = 93.2169  # squared Mahalanobis cut for the outlier flag (64 dimensions, 99%)


def _embeddings(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", "embedding")


def _mvn():
    import numpy as np

    return G.Gaussian(np.full(64, 0.001), MVN_A * np.eye(64) + MVN_B)


@query
def q_mvn_logpdf(spark, sf):
    """Log-density of all 64 embedding coordinates under a full covariance."""
    return rounded(G.score(_embeddings(spark, sf), "embedding", _mvn()).select("vec_id", "logpdf"))


@query
def q_mvn_pdf(spark, sf):
    return rounded(G.score(_embeddings(spark, sf), "embedding", _mvn(), output="pdf", density=True)
                   .select("vec_id", "pdf"))


@query
def q_mvn_logpdf_wide(spark, sf):
    """The same with a diagonal covariance."""
    import numpy as np
    g = G.Gaussian(np.zeros(64), np.eye(64) * 0.016)
    return rounded(G.score(_embeddings(spark, sf), "embedding", g).select("vec_id", "logpdf"))


@query
def q_mvn_outliers(spark, sf):
    """Outliers under the Gaussian fitted to all 64 coordinates."""
    return rounded(G.outliers(_embeddings(spark, sf), "embedding", CHI2_64DF_99)
                   .select("vec_id", "logpdf", "is_outlier"))


@query
def q_cov_matrix_wide(spark, sf):
    """Covariance of all 64 embedding coordinates."""
    return rounded_matrix(C.cov_matrix(_embeddings(spark, sf), "embedding").select("i", "j", "cov"),
                          "cov")


@query
def q_corr_pearson_wide(spark, sf):
    """Pearson correlation of all 64 embedding coordinates."""
    return rounded_matrix(C.pearson(_embeddings(spark, sf), "embedding").select("i", "j", "corr"),
                          "corr")


@query
def q_cov_matrix_tiled(spark, sf):
    """The same covariance in tiles of 16 columns a side."""
    return rounded_matrix(C.cov_matrix_tiled(_embeddings(spark, sf), "embedding", tile=16).select(
        "i", "j", "cov"), "cov")


@query
def q_linreg_predict_wide(spark, sf):
    """A fixed linear model over the embedding array."""
    model = LR.LinearModel([((j % 7) - 3) / 10 for j in range(64)], 0.25,
                           [f"embedding[{j}]" for j in range(64)])
    return rounded(model.predict(_embeddings(spark, sf), "embedding").select("vec_id", "prediction"))


# ------------------------------------------------------------- sparse vectors

def _supplier_cells(spark, sf):
    """Orders as sparse vectors: the quantity bought from each supplier."""
    cells = table(spark, sf, "lineitem").groupBy(
        F.col("l_orderkey").alias("row_id"), F.col("l_suppkey").alias("feature")).agg(
        F.sum("l_quantity").alias("value"))
    return cells, table(spark, sf, "orders").count()


@query
def q_cov_sparse(spark, sf):
    """Covariance of the quantities that orders buy from pairs of suppliers."""
    cells, n = _supplier_cells(spark, sf)
    return rounded(SP.cov_sparse(cells, num_rows=n))


@query
def q_corr_sparse(spark, sf):
    cells, n = _supplier_cells(spark, sf)
    return rounded(SP.corr_sparse(cells, num_rows=n))


@query
def q_cov_sparse_terms(spark, sf):
    """Covariance of the term counts of documents, for terms of at least a tenth of them."""
    docs = table(spark, sf, "documents")
    n = docs.count()
    # read twice, by column
    cells = written(TX.term_counts(docs, "doc_id", "text"), "cells")
    return rounded(SP.cov_sparse(cells, "doc_id", "term", "tf", num_rows=n, min_rows=-(-n // 10)))


@query
def q_chisq_features_sparse(spark, sf):
    """Presence of every term in labelled documents against good, poor and toxic ones."""
    cells = TX.term_presence(TX.term_counts(table(spark, sf, "documents"), "doc_id", "text"))
    kind = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("poor")
    rows = table(spark, sf, "labels").select("doc_id", kind.alias("kind"))
    return rounded(SP.chisq_features_sparse(cells, rows, "doc_id", "term", "tf", "kind"))


@query
def q_linreg_sgd_sparse(spark, sf):
    """Order totals from sparse line discounts, weights kept as a table."""
    cells = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        (F.sum("l_discount") * 10).alias("x"))
    rows = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                             (F.col("o_totalprice") / 100000).alias("y"))
    m = SL.train_sgd_sparse(cells, rows, "l_orderkey", "l_linenumber", "x", "y", num_iterations=6,
                            step_size=0.5, intercept=True)
    terms = m.weights.select(F.concat(F.lit("x"), F.col("feature").cast("string")).alias("term"),
                             F.col("weight").alias("coefficient"))
    return rounded(terms.unionByName(spark.createDataFrame(
        [("intercept", m.intercept)], "term string, coefficient double")))


# ------------------------------------------------------- model save and load

@query
def q_nb_model_roundtrip(spark, sf):
    """Fit, save to the shared folder, load back, show the loaded model."""
    _, model = _nb_model(spark, sf, NB.MULTINOMIAL)
    path = scratch_path(spark, "nb-model")
    MD.save_nb(model, path)
    return rounded(_nb_table(MD.load_nb(spark, path)))


@query
def q_linreg_model_roundtrip(spark, sf):
    _, model = _lr_intercept_model(spark, sf)
    path = scratch_path(spark, "linear-model")
    MD.save_linear(model, spark, path)
    return rounded(MD.load_linear(spark, path).coefficients(spark))


# ------------------------------------------------------------------ streaming

def _event_stream(spark, sf):
    """``events`` replayed as a stream of four files, one per micro-batch, so that window state
    is merged across batches, and a watermark delay.  The files cover the same days; the delay is
    longer than the table's time range, so no row is late in whatever order they are read."""
    events = table(spark, sf, "events")
    ts = F.col("ts").cast("timestamp").cast("long")
    days = events.agg(F.floor((F.max(ts) - F.min(ts)) / 86400)).first()[0] or 0
    path = scratch_path(spark, "events")
    events.repartition(4).write.parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return stream, f"{days + 2} days"


@query
def q_stream_summary(spark, sf):
    """Daily summaries of event values from a stream; equals the batch summary."""
    out, ckpt = scratch_path(spark, "stream-summary"), scratch_path(spark, "stream-ckpt")
    events, delay = _event_stream(spark, sf)
    SS.run_to_table(events, ["value"], "ts", "1 day", delay, out, ckpt)
    res = SS.finalize_windows(SS.latest_windows(spark, out), ["value"])
    return rounded(res.withColumn("day", F.to_date("window_start"))
                   .drop("window_start", "window_end"))


@query
def q_stream_summary_by_type(spark, sf):
    """Daily summaries per event type from a stream (grouped windows)."""
    out, ckpt = scratch_path(spark, "stream-type"), scratch_path(spark, "stream-type-ckpt")
    events, delay = _event_stream(spark, sf)
    SS.run_to_table(events, ["value"], "ts", "1 day", delay, out, ckpt,
                    group_by=["event_type"])
    res = SS.finalize_windows(SS.latest_windows(spark, out, ["event_type"]), ["value"],
                              ["event_type"])
    return rounded(res.withColumn("day", F.to_date("window_start"))
                   .drop("window_start", "window_end"))


@query
def q_stream_ab_test_student(spark, sf):
    """Daily Student (pooled variance) t-test of purchase values vs the rest."""
    out, ckpt = scratch_path(spark, "stream-st"), scratch_path(spark, "stream-st-ckpt")
    events, delay = _event_stream(spark, sf)
    moments = AB.windowed_moments(events, "value",
                                  F.col("event_type") == "purchase", "ts", "1 day", delay)
    SS.run_update_stream(moments, out, ckpt)
    res = AB.t_test(SS.latest_windows(spark, out), AB.STUDENT)
    return rounded(res.withColumn("day", F.to_date("window_start"))
                   .drop("window_start", "window_end"))


@query
def q_stream_ab_test(spark, sf):
    """Daily Welch t-test: value of purchase events against all other events."""
    out, ckpt = scratch_path(spark, "stream-ab"), scratch_path(spark, "stream-ab-ckpt")
    events, delay = _event_stream(spark, sf)
    moments = AB.windowed_moments(events, "value",
                                  F.col("event_type") == "purchase", "ts", "1 day", delay)
    SS.run_update_stream(moments, out, ckpt)
    res = AB.t_test(SS.latest_windows(spark, out))
    return rounded(res.withColumn("day", F.to_date("window_start"))
                   .drop("window_start", "window_end"))


# ------------------------------------------------- naive Bayes at any size, in slices

@query
def q_nb_posterior_blocked(spark, sf):
    """The posteriors of ``nb_posterior`` by a blocked matrix product."""
    rows, model = _nb_model(spark, sf, NB.MULTINOMIAL)
    # a line number occurs twice in some orders: rows are told apart by numbers of their own
    rows = ZP.with_row_index(rows.select("l_orderkey", "l_linenumber", *NB_COUNT_FEATURES), "key")
    cells = NB.dense_cells(rows, "key", NB_COUNT_FEATURES)
    got = NB.predict_proba_blocked(model, cells, rows, "key", keep=["l_orderkey", "l_linenumber"],
                                   features_per_block=2, classes_per_block=2)
    return rounded(got.select("l_orderkey", "l_linenumber", "label", "probability"))


@query
def q_nb_rollup(spark, sf):
    """A model of all ship years but 1995, from a table of counts per year: all years added up,
    one taken out again."""
    rows = _nb_rows(spark, sf, False).withColumn("year", F.year("l_shipdate"))
    counts = freeze(NB.count_table(rows, "l_returnflag", NB_COUNT_FEATURES, by=["year"]))
    left = NB.remove_counts(NB.add_counts(counts), counts.filter("year = 1995").drop("year"))
    return rounded(_nb_table(NB.fit_counts(left)))


# -------------------------------------------------------- streams without windows

@query
def q_stream_running_summary(spark, sf):
    """Summaries per event type of all events so far, after the last micro-batch."""
    out, ckpt = scratch_path(spark, "stream-running"), scratch_path(spark, "stream-running-ckpt")
    events, _ = _event_stream(spark, sf)
    ON.run_running(ON.running_state(events, ["value"], ["event_type"]), out, ckpt)
    return rounded(ON.running_summary(spark, out, ["event_type"]))


@query
def q_stream_cumulative_test(spark, sf):
    """Welch test of purchases against other events so far, per parity of the user as the
    experiment, without its first week."""
    out, ckpt = scratch_path(spark, "stream-cumulative"), scratch_path(spark, "stream-cumulative-ckpt")
    events, _ = _event_stream(spark, sf)
    events = events.withColumn("experiment", F.pmod("user_id", F.lit(2)).cast("int"))
    start = table(spark, sf, "events").agg(F.min("ts").alias("start"))
    starts = start.select(F.explode(F.array(F.lit(0), F.lit(1))).alias("experiment"), "start")
    late = ON.after_start_up(events, starts, "experiment", "ts", "7 days")
    ON.run_running(ON.cumulative_moments(late, "value", F.col("event_type") == "purchase",
                                         "experiment"), out, ckpt)
    return rounded(ON.cumulative_test(spark, out, "experiment"))


@query
def q_col_summary_embeddings_grouped(spark, sf):
    """All 64 embedding coordinates per label, states by group in every task."""
    return rounded(S.col_summary(table(spark, sf, "embeddings"), "embedding", group_by=["label"],
                                 dim=64))
