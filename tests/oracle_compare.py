"""Run registered queries against their DuckDB oracles and report matches.

    python tests/oracle_compare.py [sf_dir] [name ...]

Compares row count, column names/kinds and the sorted rows (values are
already rounded on both sides).  Also used by tests/test_oracle.py.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from statframe.session import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v + 0.0
    if hasattr(v, "tolist"):
        return tuple(v.tolist())
    if isinstance(v, list):
        return tuple(v)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__), str(x)) for x in row)


def compare(spark, con, name, sf_dir, fn, sql):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(_norm(v) for v in r) for r in sdf.collect()]
    t1 = time.time()
    scols = sdf.columns
    if sql is None:
        return dict(name=name, rows=len(srows), oracle=None, spark_s=round(t1 - t0, 2))
    res = con.sql(sql)
    dcols = res.columns
    drows = [tuple(_norm(v) for v in r) for r in res.fetchall()]
    out = dict(name=name, rows=len(srows), oracle_rows=len(drows), spark_s=round(t1 - t0, 2))
    if sorted(scols) != sorted(dcols):
        out["error"] = f"columns differ: {scols} vs {dcols}"
        return out
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE",
             "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "smallint": "SMALLINT"}
    dtypes = {c: str(t) for c, t in zip(dcols, res.types)}
    bad_types = [(f.name, f.dataType.simpleString(), dtypes[f.name]) for f in sdf.schema.fields
                 if kinds.get(f.dataType.simpleString(), "?") != dtypes[f.name]]
    if bad_types:
        out["error"] = f"types differ: {bad_types}"
        return out
    order = [dcols.index(c) for c in scols]
    drows = [tuple(r[i] for i in order) for r in drows]
    a, b = sorted(srows, key=_key), sorted(drows, key=_key)
    if len(a) != len(b):
        out["error"] = "row count differs"
    else:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        if bad:
            out["error"] = f"{len(bad)} rows differ, first: {bad[0]}"
    out["ok"] = "error" not in out
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as E
    from statframe.session import local_session

    if os.environ.get("PLAIN_SESSION"):
        # the bare session a driver might build: default partitions, no checkpoint dir
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[*]").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = local_session()
    con = duck(sf_dir)
    qs, ors = E.queries(), E.oracle_sql()
    failed = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, sf_dir, fn, ors.get(name))
        except Exception as e:  # report and go on
            r = dict(name=name, error=f"{type(e).__name__}: {str(e)[:400]}")
        failed += bool(r.get("error"))
        print(r, flush=True)
    print(f"failed: {failed}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
