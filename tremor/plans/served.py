"""Queries behind a catalog service."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.functions.temporal import within
from tremor.operators.dedup import first_per_key
from tremor.operators.filters import optional_filters


def event_summary(events: DataFrame, clusters: DataFrame, classifications: DataFrame, latest_only: bool = False) -> DataFrame:
    """Events with their cluster and classification. An event repeats once per model
    version unless ``latest_only`` keeps the highest version. All three join on the event id."""
    if latest_only:
        classifications = first_per_key(classifications, ["earthquake_id"], [F.desc("model_version")])
    c = clusters.select("id", "risk_zone", "cluster_id", "cluster_label")
    p = classifications.select(F.col("earthquake_id").alias("id"), "classified_risk_zone", "classification_confidence")
    e = events.select("id", "time", "magnitude", "latitude", "longitude", "depth", "region", "hazard_score")
    return e.join(c, "id", "left").join(p, "id", "left")


def labelled_events(summary: DataFrame, limit: int = 100) -> DataFrame:
    """The strongest events that have a risk zone."""
    return summary.filter("risk_zone is not null").orderBy(F.desc("magnitude"), "id").limit(limit).select(
        "id", "time", "magnitude", "latitude", "longitude", "depth", "region", "hazard_score", "risk_zone", "cluster_id"
    )


def classifications(rows: DataFrame, limit: int = 1000, min_confidence: float | None = None) -> DataFrame:
    """Most confident first."""
    confidence = F.col("classification_confidence")
    kept = optional_filters(rows, (min_confidence, confidence >= F.lit(min_confidence)))
    return kept.orderBy(F.desc(confidence), "earthquake_id", "model_version").limit(limit)


def hazard_zones(zones: DataFrame, risk_level: str | None = None, limit: int = 100) -> DataFrame:
    """Zones with defaults for missing values, the largest first."""
    kept = optional_filters(zones, (risk_level or None, F.col("risk_level") == F.lit(risk_level)))
    return kept.select(
        F.coalesce("risk_level", F.lit("Unknown")).alias("risk_level"),
        F.coalesce("avg_magnitude", F.lit(0.0)).alias("avg_magnitude"),
        F.coalesce("event_count", F.lit(0)).alias("event_count"),
        F.coalesce("center_lat", F.lit(0.0)).alias("center_lat"),
        F.coalesce("center_lon", F.lit(0.0)).alias("center_lon"),
        F.coalesce("boundary_coordinates", F.lit("{}")).alias("boundary_coordinates"),
    ).orderBy(F.desc("event_count"), "risk_level").limit(limit)


def viewing_rows(df: DataFrame, limit: int = 10_000) -> DataFrame:
    """A bounded set of rows for plotting, in id order."""
    return df.filter("magnitude is not null").orderBy("id").limit(limit)


def recent_depth_stats(enhanced: DataFrame, as_of, days: int = 30, digits: int = 2) -> DataFrame:
    """Statistics by depth category of the last days before ``as_of``."""
    recent = enhanced.filter(within(F.col("datetime_local"), as_of, f"{days} DAYS"))
    return recent.groupBy("depth_category").agg(
        F.count(F.lit(1)).alias("event_count"),
        *[F.round(f(c), digits).alias(n) for n, f, c in (
            ("avg_magnitude", F.avg, "magnitude"), ("max_magnitude", F.max, "magnitude"), ("min_depth", F.min, "depth"),
            ("max_depth", F.max, "depth"), ("avg_hazard_score", F.avg, "hazard_score"))],
    ).orderBy(F.desc("event_count"), "depth_category")
