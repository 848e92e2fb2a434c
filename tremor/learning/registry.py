"""A stored table of fitted models.

Each run adds its models and their metrics as rows of a new version of the table, which replaces the old one as a whole
(see ``sources.sinks.refresh_tables``). The models lie in folders of their own, written before the table names them, so a
run that fails leaves the table as it was.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.learning.models import load, save
from tremor.schemas import MODEL_TABLE
from tremor.sources.sinks import read_stored, refresh_tables

NAME = "models"
REGISTRY = T.StructType([
    *MODEL_TABLE.fields, T.StructField("run", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("trained_at", T.TimestampType()),
])


def registered(spark: SparkSession, path: str) -> DataFrame:
    """All models stored at ``path``, one row each; none if nothing was stored yet."""
    try:
        return read_stored(spark, path, NAME)
    except FileNotFoundError:
        return spark.createDataFrame([], REGISTRY)


def register(fitted: dict[str, PipelineModel], comparison: DataFrame, path: str) -> str:
    """Store the models of a comparison and add their rows; returns the run's name.

    ``comparison`` has a row of metrics for every model in ``fitted``; otherwise nothing is stored.
    """
    spark = comparison.sparkSession
    names = {row[0] for row in comparison.select("model_name").collect()}
    if names != set(fitted):
        raise ValueError(f"metrics of {sorted(names)} do not belong to models {sorted(fitted)}")
    run = uuid.uuid4().hex
    for name, model in fitted.items():
        save(model, f"{path}/fitted/{run}/{name}")
    rows = comparison.select(
        "model_name", F.col("model_name").alias("model_type"), "accuracy", F.col("precision").alias("precision_score"),
        F.col("recall").alias("recall_score"), "f1_score", "training_samples", F.lit(run).alias("run"),
        F.concat(F.lit(f"{path}/fitted/{run}/"), "model_name").alias("path"), F.current_timestamp().alias("trained_at"),
    )
    added = rows.select(*[F.col(f.name).cast(f.dataType) for f in REGISTRY.fields])
    refresh_tables({NAME: registered(spark, path).unionByName(added)}, path)
    return run


def latest(models: DataFrame) -> DataFrame:
    """The rows of the run that was stored last."""
    last = models.agg(F.max_by("run", F.struct("trained_at", "run")).alias("r"))
    return models.filter(F.col("run") == last.scalar())


def current_model(spark: SparkSession, path: str) -> PipelineModel | None:
    """The model of the last run with the highest F1; without any, none."""
    best = latest(registered(spark, path)).orderBy(F.desc("f1_score"), "model_name").first()
    return load(best["path"]) if best else None
