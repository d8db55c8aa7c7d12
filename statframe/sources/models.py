"""Model persistence (IO1-IO6).

A saved model is a directory::

    <path>/metadata   one-line JSON text (class, version, sizes, model type)
    <path>/data/...   Parquet tables

Naive Bayes keeps its long tables (``prior``, ``cond``) — written by the
executors in parallel, so a large vocabulary never passes through the
driver.  Version "2.0" records the model type; "1.0" has none and loads as
multinomial.  Loading checks the stored schema and the shapes (one prior row
per class, one cond row per class and feature) with aggregates.

A linear model is one row ``(weights array<double>, intercept double)`` —
bounded by the number of features.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statframe.operators.bayes import MULTINOMIAL, NaiveBayesModel, label_order
from statframe.operators.linear import LinearModel
from statframe.session import freeze

NB_CLASS = "statframe.NaiveBayesModel"
LINEAR_CLASS = "statframe.LinearRegressionModel"


def _write_model(spark: SparkSession, path: str, meta: dict, tables: dict[str, DataFrame],
                 overwrite: bool) -> None:
    """Data first, metadata last: a folder without metadata is no model.  An existing model
    is an error unless ``overwrite``; its tables are checkpointed first, so that a loaded
    model can be saved onto its own path."""
    if overwrite:
        tables = {name: freeze(df) for name, df in tables.items()}
    mode = "overwrite" if overwrite else "error"
    for name, df in tables.items():
        df.write.mode(mode).parquet(f"{path}/{name}")
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "value string") \
        .coalesce(1).write.mode(mode).text(f"{path}/metadata")


def read_metadata(spark: SparkSession, path: str) -> dict:
    rows = spark.read.text(f"{path}/metadata").limit(1).collect()
    if not rows:
        raise ValueError(f"no model metadata under {path}")
    return json.loads(rows[0]["value"])


# ----------------------------------------------------------------- naive Bayes

def save_nb(model: NaiveBayesModel, path: str, version: str = "2.0",
            overwrite: bool = False) -> None:
    spark = model.prior.sparkSession
    if version not in ("1.0", "2.0"):
        raise ValueError(f"unknown model format version {version}")
    if version == "1.0" and model.model_type != MULTINOMIAL:
        raise ValueError("format 1.0 stores multinomial models only")
    meta = {"class": NB_CLASS, "version": version, "numFeatures": model.num_features,
            "numClasses": model.num_classes, "smoothing": model.smoothing,
            "labelType": model.prior.schema["label"].dataType.simpleString(),
            "featureType": model.cond.schema["feature"].dataType.simpleString(),
            "featureNames": model.feature_names}
    if version == "2.0":
        meta["modelType"] = model.model_type
    _write_model(spark, path, meta, {"data/prior": model.prior, "data/cond": model.cond}, overwrite)


def load_nb(spark: SparkSession, path: str) -> NaiveBayesModel:
    meta = read_metadata(spark, path)
    if meta.get("class") != NB_CLASS:
        raise ValueError(f"not a naive Bayes model: {meta.get('class')}")
    version = meta.get("version")
    if version == "1.0":
        model_type = MULTINOMIAL
    elif version == "2.0":
        model_type = meta["modelType"]
    else:
        raise ValueError(f"unknown model format version {version}")
    label_t = T._parse_datatype_string(meta["labelType"])
    feature_t = T._parse_datatype_string(meta["featureType"])
    prior_schema = T.StructType([T.StructField("label", label_t), T.StructField("pi", T.DoubleType())])
    cond_schema = T.StructType([T.StructField("label", label_t),
                                T.StructField("feature", feature_t),
                                T.StructField("theta", T.DoubleType())])
    prior = spark.read.parquet(f"{path}/data/prior")
    cond = spark.read.parquet(f"{path}/data/cond")
    for name, df, want in (("prior", prior, prior_schema), ("cond", cond, cond_schema)):
        got = [(f.name, f.dataType) for f in df.schema.fields]
        exp = [(f.name, f.dataType) for f in want.fields]
        if got != exp:
            raise ValueError(f"stored {name} schema {got} does not match {exp}")
    num_classes, num_features = int(meta["numClasses"]), int(meta["numFeatures"])
    pis = sorted(prior.collect(), key=lambda r: label_order(r["label"]))  # C rows
    if len(pis) != num_classes:
        raise ValueError(f"expected {num_classes} classes, found {len(pis)}")
    shape = cond.groupBy("label").agg(F.count(F.lit(1)).alias("k")).agg(
        F.count(F.lit(1)).alias("labels"), F.min("k").alias("lo"), F.max("k").alias("hi")
    ).collect()[0]
    if shape["labels"] != num_classes or shape["lo"] != num_features or shape["hi"] != num_features:
        raise ValueError("stored conditional table does not have numClasses x numFeatures cells")
    return NaiveBayesModel([r["label"] for r in pis], model_type, float(meta["smoothing"]),
                           num_features, prior, cond, meta.get("featureNames"),
                           [r["pi"] for r in pis])


# ------------------------------------------------------------------ linear

def save_linear(model: LinearModel, spark: SparkSession, path: str,
                overwrite: bool = False) -> None:
    meta = {"class": LINEAR_CLASS, "version": "1.0", "numFeatures": model.num_features,
            "featureNames": model.feature_names}
    data = spark.createDataFrame([(model.weights, float(model.intercept))],
                                 "weights array<double>, intercept double").coalesce(1)
    _write_model(spark, path, meta, {"data": data}, overwrite)


def load_linear(spark: SparkSession, path: str) -> LinearModel:
    meta = read_metadata(spark, path)
    if meta.get("class") != LINEAR_CLASS or meta.get("version") != "1.0":
        raise ValueError(f"not a version 1.0 linear model: {meta}")
    schema = T.StructType([T.StructField("weights", T.ArrayType(T.DoubleType())),
                           T.StructField("intercept", T.DoubleType())])
    data: DataFrame = spark.read.parquet(f"{path}/data")
    got = [(f.name, f.dataType) for f in data.schema.fields]
    if got != [(f.name, f.dataType) for f in schema.fields]:
        raise ValueError(f"stored linear model schema {got} does not match")
    row = data.limit(1).collect()[0]
    if len(row["weights"]) != int(meta["numFeatures"]):
        raise ValueError("stored weights do not match numFeatures")
    return LinearModel(list(row["weights"]), row["intercept"], meta["featureNames"])
