"""Batch ETL profile: clean, derive features, aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.functions import classify, scores, temporal, text
from tremor.operators.dedup import latest_per_key
from tremor.operators.filters import valid_events
from tremor.operators.stats import (
    approximate_medians, category_distribution, monthly_stats, with_relative_magnitudes, zone_stats,
)
from tremor.workspace import constants, materialise

NUMERIC = ["magnitude", "depth", "felt", "cdi", "mmi", "sig", "nst", "dmin", "rms", "gap"]
CATEGORICAL = ["alert", "status", "magnitude_type", "type", "net"]
TEXT = ["place", "alert", "status", "magnitude_type", "type"]


def fill_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs become the approximate median of their column; all medians come from one pass."""
    medians = constants(approximate_medians(df, columns))
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({
        c: F.coalesce(F.col(c), medians[c].cast(kinds[c])) for c in columns
    })


def fill_unknown(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.fillna("unknown", columns)


def clean(catalog: DataFrame) -> DataFrame:
    """One version per id, valid values, no missing fields, plain text, standard alerts."""
    unique = latest_per_key(catalog, ["id"], ["updated", "time", "place", "magnitude", "depth", "latitude", "longitude"])
    # Written once: the medians, and later the averages, read it again.
    valid = materialise(valid_events(unique), "valid-events")
    filled = fill_unknown(fill_medians(valid, NUMERIC), CATEGORICAL)
    stripped = filled.withColumns({c: text.strip_text(F.col(c)) for c in TEXT})
    return stripped.withColumn("alert_standardized", text.standard_alert(F.col("alert")))


def with_features(df: DataFrame) -> DataFrame:
    """Calendar parts, categories, zone, distances, energy, risk and impact."""
    lat, lon, m, d = (F.col(c) for c in ("latitude", "longitude", "magnitude", "depth"))
    return (
        df.withColumns(temporal.calendar_parts(F.col("time")))
        .withColumns({
            "magnitude_category": classify.magnitude_level(m),
            "depth_category_detailed": classify.depth_level(d),
            "geographic_zone": classify.geographic_zone(lon, lat),
            "ring_of_fire_distance": scores.ring_of_fire_distance(lat, lon),
            "energy_release_log": scores.log_energy(m),
            "risk_score": scores.weighted_risk(m, d, F.col("alert_standardized")),
            "season": temporal.season_name(F.col("month")),
        })
        .withColumns({
            "population_impact_estimate": scores.zone_impact(m, F.col("geographic_zone")),
            "tectonic_activity_score": scores.tectonic_activity(F.col("geographic_zone")),
        })
    )


def statistics(features: DataFrame) -> dict[str, DataFrame]:
    return {
        "regional_stats": zone_stats(features),
        "temporal_stats": monthly_stats(features),
        "magnitude_distribution": category_distribution(features),
    }


def run(catalog: DataFrame) -> DataFrame:
    """The whole profile: cleaned events with features and relative magnitudes."""
    return with_relative_magnitudes(with_features(clean(catalog)))


def enhance(catalog: DataFrame) -> DataFrame:
    """The hazard profile: local time, categories, intensity, alert level, hazard and quality."""
    lat, lon, m, d = (F.col(c) for c in ("latitude", "longitude", "magnitude", "depth"))
    local = catalog.withColumn("datetime_local", temporal.local_time(F.col("time")))
    return local.withColumns({
        "year": F.year("datetime_local"), "month": F.month("datetime_local"), "hour": F.hour("datetime_local"),
        "depth_category": classify.depth_class(d),
        "magnitude_hazard": classify.magnitude_hazard(m),
        "intensity_score": scores.intensity_score(F.col("felt"), F.col("cdi"), F.col("mmi")).cast("double"),
        "alert_level": text.alert_level(F.col("alert")),
        "region": classify.region(lon, lat),
        "data_quality": classify.quality_flag(F.col("gap"), F.col("rms"), F.col("nst")),
    }).withColumn(
        "hazard_score",
        scores.impact_hazard(m, F.col("intensity_score"), F.col("alert_level"), F.col("tsunami"), d),
    )


ENHANCED_COLUMNS = [
    "id", "place", "datetime_local", "latitude", "longitude", "region", "depth", "magnitude", "tsunami",
    "depth_category", "alert_level", "magnitude_hazard", "hazard_score", "intensity_score",
]
