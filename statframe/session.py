"""Session helpers: building a local session for tests/bench, table loading,
and a reliable checkpoint directory taken from the session's own config."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "statframe") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of this session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is used
    as is.  Only a local-mode session without one (tests, bench) gets a fresh
    scratch folder; a cluster session without the setting is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context on the client; the server's setting applies
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("spark.checkpoint.dir is not set on the server session")
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder so "
            "checkpointed stages survive executor loss")
    path = tempfile.mkdtemp(prefix="statframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared checkpoint folder for written tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def freeze(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable (eager) checkpoint in the shared folder.

    Used where a recomputation could differ from the first run (range
    sampling, generated row ids), so that a lost executor cannot make two
    consumers of the same stage disagree.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the shared folder, read back: for a long table that is read more than once, which a
    checkpoint would hand out row by row."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
