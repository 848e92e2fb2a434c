"""The hazard chain: catalog, density, hazard score, clusters, risk zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.constants import DBSCAN_EPS, DBSCAN_MIN_SAMPLES, GRID_SIZE
from tremor.functions import classify, scores, text
from tremor.operators import hazard
from tremor.operators.dbscan import dbscan
from tremor.operators.density import with_density
from tremor.operators.filters import require_columns, valid_events, without_noise
from tremor.schemas import CATALOG
from tremor.sources.sinks import refresh_tables
from tremor.workspace import materialise

PROCESSED_COLUMNS = [
    "id", "magnitude", "latitude", "longitude", "depth", "time", "place", "spatial_density", "hazard_score",
    "region", "magnitude_category", "depth_category", "tsunami", "alert",
]


def ingest(catalog: DataFrame) -> DataFrame:
    """Batch ingestion features: region, distance, squared magnitude, plain place names."""
    lat, lon, m = F.col("latitude"), F.col("longitude"), F.col("magnitude")
    return valid_events(catalog).withColumns({
        "indonesian_region": classify.region(lon, lat),
        "distance_from_jakarta": scores.distance_from_jakarta(lat, lon),
        "magnitude_squared": scores.magnitude_squared(m),
        "processing_stage": F.lit("spark_processed"),
        "place": text.strip_place(F.col("place")),
    })


def process(catalog: DataFrame, grid: float = GRID_SIZE, edge: str = "first") -> DataFrame:
    """Valid events with region, categories, density and hazard score."""
    require_columns(catalog, [f.name for f in CATALOG.fields if f.name in ("id", "latitude", "longitude", "magnitude", "depth")])
    lat, lon, m, d = (F.col(c) for c in ("latitude", "longitude", "magnitude", "depth"))
    classed = valid_events(catalog).withColumns({
        "region": classify.region(lon, lat),
        "magnitude_category": classify.magnitude_class(m),
        "depth_category": classify.depth_class(d),
    })
    return with_density(classed, grid, edge).withColumn(
        "hazard_score", scores.density_hazard(m, d, F.col("region"), F.col("spatial_density"))
    )


def cluster(
    processed: DataFrame, eps: float = DBSCAN_EPS, min_samples: int = DBSCAN_MIN_SAMPLES, labels: DataFrame | None = None
) -> DataFrame:
    """Clustered events with their cluster's summary and seed risk zone; noise is left out.

    ``processed`` should be a written table. ``labels`` passes on an earlier clustering of it.
    """
    require_columns(processed, ["id", "latitude", "longitude", "magnitude", "depth", "spatial_density", "hazard_score"])
    labels = dbscan(processed, eps, min_samples) if labels is None else labels
    numbered = without_noise(labels).select("id", "cluster_id")
    events = materialise(
        processed.select("id", "latitude", "longitude", "magnitude").join(numbered, "id"), "clustered"
    )
    return hazard.seed_risk_zones(hazard.attach_cluster_summary(events)).select(
        "id", "cluster_id", "cluster_label", "risk_zone", "centroid_lat", "centroid_lon", "cluster_size",
        "avg_magnitude", "max_magnitude",
    )


def tables(catalog: DataFrame, eps: float = DBSCAN_EPS, min_samples: int = DBSCAN_MIN_SAMPLES) -> dict[str, DataFrame]:
    """The four stored tables of a run, written once and read back."""
    processed = materialise(process(catalog).select(*PROCESSED_COLUMNS), "processed")
    return stored_tables(processed, materialise(cluster(processed, eps, min_samples), "clusters"))


def stored_tables(processed: DataFrame, clusters: DataFrame) -> dict[str, DataFrame]:
    return {
        "earthquakes_processed": processed,
        "earthquake_clusters": clusters,
        "earthquake_risk_classifications": hazard.classification_rows(clusters),
        "hazard_zones": hazard.hazard_zones(clusters),
    }


# Every key of a child table is in its parent: (child, key, parent, parent key).
REFERENCES = (
    ("earthquake_clusters", "id", "earthquakes_processed", "id"),
    ("earthquake_risk_classifications", "earthquake_id", "earthquakes_processed", "id"),
)


def store(stored: dict[str, DataFrame], path: str) -> DataFrame:
    """Make the four tables of a run the current version at ``path``, or leave the old one; (table_name, rows)."""
    return refresh_tables(stored, path, REFERENCES)


def run(catalog: DataFrame, path: str, eps: float = DBSCAN_EPS, min_samples: int = DBSCAN_MIN_SAMPLES) -> DataFrame:
    """The whole job: cluster the catalog and store its tables; read them with ``read_stored(spark, path, name)``."""
    return store(tables(catalog, eps, min_samples), path)


def zone_ranking(catalog: DataFrame, eps: float = DBSCAN_EPS, min_samples: int = DBSCAN_MIN_SAMPLES) -> DataFrame:
    """Every cluster of the catalog with its profile, the most hazardous first."""
    processed = materialise(process(catalog).select(*PROCESSED_COLUMNS), "processed")
    labels = dbscan(processed, eps, min_samples).select("id", "cluster_id")
    return hazard.ranked_zones(hazard.cluster_profiles(processed.join(labels, "id")))


