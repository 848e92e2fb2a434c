"""Streaming ingestion of event features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tremor.operators.filters import valid_stream_events
from tremor.schemas import FEATURE
from tremor.sources.geojson import catalog_columns

STREAM_COLUMNS = ["id", "magnitude", "place", "time", "longitude", "latitude", "depth"]


def read_feature_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Files with one feature per JSON record; the schema is declared, as streams require."""
    reader = spark.readStream.schema(FEATURE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def transform_features(features: DataFrame) -> DataFrame:
    """Flatten, keep valid events, stamp with the processing time. Works on batches and streams."""
    flat = features.select(*catalog_columns("")).select(*STREAM_COLUMNS)
    return valid_stream_events(flat).withColumn("processed_at", F.current_timestamp())


def start_ingest(
    stream: DataFrame, checkpoint: str, path: str | None = None, available_now: bool = False
) -> StreamingQuery:
    """Append to Parquet at ``path``, or print to the console without one."""
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    if path is None:
        return writer.format("console").option("truncate", False).start()
    return writer.format("parquet").option("path", path).start()
