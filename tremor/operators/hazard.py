"""Cluster summaries, risk zones and hazard zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.constants import DEFAULT_CONFIDENCE, HIGH_RISK, MODEL_VERSION
from tremor.functions.classify import cluster_risk
from tremor.functions.text import cluster_label
from tremor.operators.dedup import first_per_key
from tremor.operators.skew import balanced_join
from tremor.workspace import materialise


def cluster_summary(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("cluster_id").agg(
        F.avg("magnitude").alias("avg_magnitude"), F.max("magnitude").alias("max_magnitude"),
        F.count("id").cast("int").alias("cluster_size"),
        F.avg("latitude").alias("centroid_lat"), F.avg("longitude").alias("centroid_lon"),
    )


def attach_cluster_summary(clustered: DataFrame) -> DataFrame:
    """Left join of each event with the summary of its cluster, plus ``cluster_label``."""
    summary = materialise(cluster_summary(clustered), "cluster-summary")
    return balanced_join(clustered, summary, ["cluster_id"], "left", ["id"]).withColumn(
        "cluster_label", cluster_label(F.col("cluster_id"))
    )


def seed_risk_zones(clusters: DataFrame) -> DataFrame:
    """Risk zone from the strongest event of the cluster; the labels a first model is trained on."""
    return clusters.withColumn("risk_zone", cluster_risk(F.col("max_magnitude")))


def majority_risk(clusters: DataFrame) -> DataFrame:
    """One risk zone per cluster: the most frequent, the alphabetically first among equals."""
    counted = clusters.groupBy("cluster_id", "risk_zone").agg(F.count(F.lit(1)).alias("events"))
    return first_per_key(counted, ["cluster_id"], [F.desc("events"), F.asc("risk_zone")]).select(
        "cluster_id", F.col("risk_zone").alias("cluster_risk")
    )


def hazard_zones(clusters: DataFrame) -> DataFrame:
    """High and extreme risk levels; averages weigh every event of a cluster."""
    return clusters.filter(F.col("risk_zone").isin(*HIGH_RISK)).groupBy(F.col("risk_zone").alias("risk_level")).agg(
        F.avg("avg_magnitude").alias("avg_magnitude"), F.count("id").cast("int").alias("event_count"),
        F.avg("centroid_lat").alias("center_lat"), F.avg("centroid_lon").alias("center_lon"),
    ).withColumns({
        "boundary_coordinates": F.lit(None).cast("string"), "area_km2": F.lit(None).cast("double"),
    })


def classification_rows(clusters: DataFrame, confidence=None) -> DataFrame:
    """One row per event with its classified zone; a model's probability may replace the fixed confidence."""
    confidence = F.lit(DEFAULT_CONFIDENCE) if confidence is None else confidence
    return clusters.select(
        F.col("id").alias("earthquake_id"), F.col("risk_zone").alias("classified_risk_zone"),
        confidence.alias("classification_confidence"), F.lit(MODEL_VERSION).alias("model_version"),
    )


def risk_zone_summary(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("risk_zone").agg(
        F.countDistinct("cluster_id").alias("cluster_count"), F.count(F.lit(1)).alias("total_events"),
        F.avg("avg_magnitude").alias("avg_magnitude"), F.max("avg_magnitude").alias("max_magnitude"),
    )


def clustering_report(clusters: DataFrame) -> DataFrame:
    """One nested row over :func:`risk_zone_summary`. There are only a handful of risk zones."""
    zones = risk_zone_summary(clusters)
    total = clusters.agg(F.countDistinct("cluster_id").alias("n")).scalar()
    row = F.struct(
        F.coalesce("risk_zone", F.lit("Unknown")).alias("risk_zone"), "cluster_count", "total_events",
        "avg_magnitude", "max_magnitude",
    )
    return zones.agg(
        F.sort_array(F.collect_list(row)).alias("risk_zones"),
        F.count_if(F.col("risk_zone").isin(*HIGH_RISK)).alias("high_risk_zones"),
        F.coalesce(F.sum("total_events"), F.lit(0)).alias("total_clustered_events"),
        F.count(F.lit(1)).alias("risk_zone_diversity"),
        F.coalesce(F.max("total_events"), F.lit(0)).alias("largest_zone_events"),
        F.coalesce(F.max("max_magnitude"), F.lit(0.0)).alias("max_magnitude"),
        F.coalesce(F.avg("avg_magnitude"), F.lit(0.0)).alias("mean_of_zone_means"),
    ).withColumn("total_clusters", total)


def cluster_profiles(events: DataFrame) -> DataFrame:
    """Profile of every cluster and of the noise: centre, averages, alarms and the most frequent region
    (the alphabetically first among equals; regions are a fixed handful).

    Takes events with cluster_id, region, hazard_score, tsunami and alert.
    """
    name = F.when(F.col("cluster_id") == -1, "Noise/Outliers").otherwise(
        F.concat(F.lit("Hazard Zone "), (F.col("cluster_id") + 1).cast("string"))
    )
    return events.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("count"), F.avg("magnitude").alias("avg_magnitude"),
        F.max("magnitude").alias("max_magnitude"), F.avg("depth").alias("avg_depth"),
        F.avg("hazard_score").alias("avg_hazard_score"), F.count_if(F.col("tsunami") == 1).alias("tsunami_events"),
        F.count_if(F.col("alert").isin("orange", "red")).alias("high_alert_events"),
        F.mode("region", True).alias("dominant_region"),
        F.avg("latitude").alias("latitude_center"), F.avg("longitude").alias("longitude_center"),
    ).withColumn("cluster_name", name)


def cluster_list(clusters: DataFrame) -> DataFrame:
    """One row per cluster, taken from its event with the smallest id."""
    return first_per_key(clusters, ["cluster_id"], [F.asc("id")]).select(
        "cluster_id", "cluster_label", "risk_zone", "centroid_lat", "centroid_lon", "cluster_size",
        "avg_magnitude", "max_magnitude",
    )


def ranked_zones(profiles: DataFrame) -> DataFrame:
    """Clusters without the noise, the most hazardous first."""
    return profiles.filter("cluster_id <> -1").orderBy(F.desc("avg_hazard_score"), "cluster_id")
