"""Row numbers and positional pairing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from statframe.operators import zipped as ZP


def frame(spark, values, name, parts):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], f"i int, {name} double")
    return df.repartitionByRange(parts, "i").sortWithinPartitions("i").select(name)


@pytest.mark.parametrize("parts", [1, 8, 13])
def test_row_numbers_follow_the_order(spark, parts):
    v = np.random.default_rng(1).normal(size=200)
    got = {r["row_index"]: r["v"] for r in ZP.with_row_index(frame(spark, v, "v", parts)).collect()}
    assert [got[i] for i in range(200)] == list(v)


def test_same_at_one_and_eight_partitions(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=300)
    y = x + rng.normal(size=300)
    want = np.corrcoef(x, y)[0, 1]
    for a, b in ((1, 1), (1, 8), (8, 3)):
        r = ZP.corr_zipped(frame(spark, x, "x", a), frame(spark, y, "y", b), "x", "y").first()
        assert r["corr"] == pytest.approx(want, abs=1e-12)
        assert (r["col_i"], r["col_j"]) == ("x", "y")
    r = ZP.corr_zipped(frame(spark, x, "x", 4), frame(spark, x ** 3, "y", 2), "x", "y", "spearman").first()
    assert r["corr"] == pytest.approx(1.0)


def test_sizes_names_and_empty(spark):
    a, b = frame(spark, range(5), "x", 2), frame(spark, range(6), "y", 2)
    with pytest.raises(ValueError, match="5 and 6 rows"):
        ZP.zip_rows(a, b)
    with pytest.raises(ValueError, match="two columns named x"):
        ZP.zip_rows(a, a)
    assert ZP.zip_rows(a.limit(0), b.limit(0)).collect() == []
    odd = a.select(F.col("x").alias("a.b"), F.lit(None).cast("string").alias("file"))
    got = ZP.with_row_index(odd, "n")
    assert got.columns == ["a.b", "file", "n"] and got.count() == 5
