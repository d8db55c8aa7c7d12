"""Yardstick: the matching built-in pyspark.ml / pyspark.mllib calls on the same
tables and session settings as bench.py (median of BENCH_RUNS warm runs).

    BENCH_SF_DIR=/root/testdata/sf0.1 python bench_builtin.py
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import ChiSquareTest, Correlation, KolmogorovSmirnovTest, Summarizer
    from pyspark.mllib.regression import LabeledPoint, LinearRegressionWithSGD
    from pyspark.sql import functions as F

    from statframe.session import local_session

    spark = local_session(app="statframe-builtin")
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    ev = spark.read.parquet(f"{sf}/events.parquet")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    vec = VectorAssembler(inputCols=cols, outputCol="v")

    def summary():
        v = vec.transform(li)
        v.select(Summarizer.metrics("mean", "variance", "numNonZeros", "max", "min", "normL1",
                                    "normL2", "count").summary(v.v)).collect()

    def corr(method):
        return lambda: Correlation.corr(vec.transform(li), "v", method).collect()

    def chisq():
        d = li.select((F.col("l_linestatus") == "F").cast("double").alias("label"),
                      F.col("l_tax"), F.col("l_discount"))
        v = VectorAssembler(inputCols=["l_tax", "l_discount"], outputCol="v").transform(d)
        ChiSquareTest.test(v, "v", "label").collect()

    def ks():
        KolmogorovSmirnovTest.test(ev, "value", "norm", 50.0, 50.0).collect()

    def nb():
        d = li.select((F.col("l_returnflag") == "R").cast("double").alias("label"),
                      "l_quantity", F.round(F.col("l_discount") * 100).alias("d"),
                      F.round(F.col("l_tax") * 100).alias("t"))
        v = VectorAssembler(inputCols=["l_quantity", "d", "t"], outputCol="features").transform(d)
        NaiveBayes(smoothing=1.0).fit(v)

    def sgd():
        d = li.select((F.col("l_extendedprice") / 10000).alias("y"),
                      (F.col("l_quantity") / 10).alias("q"), (F.col("l_discount") * 10).alias("d"),
                      (F.col("l_tax") * 10).alias("t"))
        pts = d.rdd.map(lambda r: LabeledPoint(r["y"], [r["q"], r["d"], r["t"]]))
        LinearRegressionWithSGD.train(pts, iterations=100, step=0.1)

    cases = {"col_summary": summary, "corr_pearson_matrix": corr("pearson"),
             "corr_spearman_matrix": corr("spearman"), "chisq_features": chisq,
             "ks_norm": ks, "nb_multinomial_fit": nb, "linreg_sgd": sgd}
    out = {}
    for name, fn in cases.items():
        fn()
        ts = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn()
            ts.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(ts), 3)
        print(f"# {name}: {out[name]}s", file=sys.stderr, flush=True)
    print(json.dumps({"builtin": out, "sf_dir": sf, "runs": runs}))


if __name__ == "__main__":
    main()
