"""Nested event features: files of feature collections and their flat form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.functions.temporal import from_millis
from tremor.schemas import FEATURE_COLLECTION


def read_collections(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Feature collections. A file that is one big document is read by one task, so land many
    moderate files, or one collection per line with ``one_per_file=False``."""
    return spark.read.schema(FEATURE_COLLECTION).option("multiLine", one_per_file).json(path)


def catalog_columns(feature: str) -> list[Column]:
    """Projection of one feature struct to the canonical catalog; a short coordinate list gives NULLs."""
    def prop(name: str) -> Column:
        return F.col(f"{feature}properties.{name}")

    coordinates = F.col(f"{feature}geometry.coordinates")
    return [
        F.col(f"{feature}id").alias("id"),
        from_millis(prop("time")).alias("time"), from_millis(prop("updated")).alias("updated"),
        F.get(coordinates, F.lit(1)).alias("latitude"), F.get(coordinates, F.lit(0)).alias("longitude"),
        F.get(coordinates, F.lit(2)).alias("depth"), prop("mag").alias("magnitude"),
        prop("magType").alias("magnitude_type"), prop("place").alias("place"), prop("felt").alias("felt"),
        prop("cdi").alias("cdi"), prop("mmi").alias("mmi"), prop("alert").alias("alert"),
        prop("status").alias("status"), prop("tsunami").alias("tsunami"), prop("sig").alias("sig"),
        prop("net").alias("net"), prop("nst").alias("nst"), prop("dmin").alias("dmin"), prop("rms").alias("rms"),
        prop("gap").alias("gap"), prop("type").alias("type"),
    ]


def flatten_collections(collections: DataFrame) -> DataFrame:
    """One canonical catalog row per feature."""
    return collections.select(F.explode("features").alias("f")).select(*catalog_columns("f."))


def to_features(catalog: DataFrame) -> DataFrame:
    """Catalog rows as nested features (id, properties, geometry)."""
    return catalog.select(
        "id",
        F.struct(
            F.col("magnitude").alias("mag"), "place", F.unix_millis("time").alias("time"),
            F.unix_millis("updated").alias("updated"), "felt", "cdi", "mmi", "alert", "status", "tsunami", "sig",
            "net", "nst", "dmin", "rms", "gap", F.col("magnitude_type").alias("magType"), "type",
        ).alias("properties"),
        F.struct(F.array("longitude", "latitude", "depth").alias("coordinates")).alias("geometry"),
    )
