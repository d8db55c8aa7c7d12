"""Plan shape checks: pruning and pushdown reach the scan, ranks never funnel
through one partition, dense scoring does not shuffle."""

from pyspark.sql import functions as F

from statframe.operators import bayes as NB
from statframe.operators import rank as R
from statframe.operators import summary as S


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_summary_reads_only_needed_columns(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    p = plan(S.col_summary(li.filter(F.col("l_returnflag") == "R"), ["l_quantity", "l_tax"]))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "ReadSchema: struct<l_quantity:double,l_tax:double,l_returnflag:string>" in scan
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in scan


def test_rank_has_no_single_partition_exchange(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    p = plan(R.avg_rank(li, ["l_extendedprice"]))
    assert "SinglePartition" not in p
    assert "rangepartitioning" not in p.lower()  # the range split is checkpointed, not replanned


def test_dense_nb_scoring_is_a_projection(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    m = NB.fit(li, "l_returnflag", ["l_quantity"])
    p = plan(NB.predict(m, li))
    assert "Exchange" not in p


def _jobs_in(spark, group, fn):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return sc.statusTracker().getJobIdsForGroup(group)


# With AQE a shuffle map stage runs as a job of its own, so "one pass" is one
# aggregate: a map-stage job over the data plus the final job over its output.

def test_sgd_jobs_do_not_grow_with_iterations(spark):
    from statframe.operators import linear as L

    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(
        (F.col("l_extendedprice") / 10000).alias("y"), (F.col("l_quantity") / 10).alias("q"))
    for fraction in (1.0, 0.3):
        one = _jobs_in(spark, f"sgd1-{fraction}", lambda: L.train_sgd(
            li, "y", ["q"], num_iterations=1, step_size=0.1, mini_batch_fraction=fraction,
            convergence_tol=0.0))
        many = _jobs_in(spark, f"sgd100-{fraction}", lambda: L.train_sgd(
            li, "y", ["q"], num_iterations=100, step_size=0.1, mini_batch_fraction=fraction,
            convergence_tol=0.0))
        assert len(many) == len(one) <= 2


def test_dense_nb_fit_is_one_aggregate(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    jobs = _jobs_in(spark, "nb-jobs", lambda: NB.fit(li, "l_returnflag", ["l_quantity", "l_tax"]))
    assert len(jobs) <= 2


def test_feature_tests_scan_the_table_once(spark):
    from statframe.operators import hypothesis as H

    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    df = H.chisq_features(li, "l_linestatus", ["l_returnflag", "l_tax", "l_discount"])
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 0  # the data was read once, into the checkpoint


def test_scaled_sgd_is_one_aggregate(spark):
    from statframe.operators import linear as L

    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plain = _jobs_in(spark, "sgd-plain", lambda: L.train_sgd(
        li, "l_extendedprice", ["l_quantity", "l_tax"], num_iterations=5, step_size=0.1))
    scaled = _jobs_in(spark, "sgd-scaled", lambda: L.train_sgd(
        li, "l_extendedprice", ["l_quantity", "l_tax"], num_iterations=5, step_size=0.1,
        feature_scaling=True))
    assert len(scaled) == len(plain)
