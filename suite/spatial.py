"""Density, clustering and hazard zones."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.base import Tables, query, rounded, stamp as as_text
from suite.sql import CLUSTERS, EV, LABELS, PROC, REGION, VALID, r, stamp
from tremor.operators import hazard
from tremor.operators.augment import augment
from tremor.operators.dbscan import dbscan
from tremor.operators.density import density_table, with_density
from tremor.plans import master

c = F.col


@query("a5_cell_density", f"WITH {PROC} SELECT lat_grid, lon_grid, grid_count, {r('grid_count/((0.1::DOUBLE*111)*(0.1::DOUBLE*111))')} AS density FROM cells")
def _(t: Tables):
    return rounded(density_table(t.processed), "density")


@query("g1_grid_density", f"WITH {PROC} SELECT id, {r('spatial_density')} AS spatial_density FROM dens")
def _(t: Tables):
    return rounded(with_density(t.processed.drop("spatial_density")), "spatial_density").select("id", "spatial_density")


@query("g1_grid_density_open_edge", f"""WITH {PROC}, g AS (SELECT id, CASE WHEN latitude > lat0 THEN ceil((latitude-lat0)/0.1::DOUBLE) END AS a, CASE WHEN longitude > lon0 THEN ceil((longitude-lon0)/0.1::DOUBLE) END AS b FROM val, org),
 n AS (SELECT a, b, count(*) AS n FROM g WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY 1,2)
 SELECT id, {r('n/((0.1::DOUBLE*111)*(0.1::DOUBLE*111))')} AS spatial_density FROM g LEFT JOIN n USING (a, b)""")
def _(t: Tables):
    opened = with_density(t.processed.drop("spatial_density"), edge="drop")
    return rounded(opened, "spatial_density").select("id", "spatial_density")


@query("g2_dbscan", f"WITH RECURSIVE {LABELS} SELECT id, cluster_id, is_core FROM labels")
def _(t: Tables):
    return dbscan(t.processed)


@query("g2_dbscan_regional", f"""WITH {PROC}, q AS (SELECT id, radians(latitude) AS p, radians(longitude) AS l, sin(radians(latitude)) AS z,
 cos(radians(latitude))*cos(radians(longitude)) AS x, cos(radians(latitude))*sin(radians(longitude)) AS y FROM proc),
 n AS (SELECT a.id, count(*) AS near FROM q a JOIN q b ON pow(a.x-b.x,2)+pow(a.y-b.y,2)+pow(a.z-b.z,2) <= pow(2*sin(0.05::DOUBLE),2) GROUP BY a.id)
 SELECT id, near >= 5 AS is_core FROM n""")
def _(t: Tables):
    """The core events; the clusters themselves are compared with brute force in the tests."""
    from tremor.constants import DBSCAN_EPS_REGIONAL

    return dbscan(t.processed, eps=DBSCAN_EPS_REGIONAL).select("id", "is_core")


@query("a6_cluster_summary", f"""WITH RECURSIVE {CLUSTERS} SELECT cluster_id, {r('avg_magnitude')} AS avg_magnitude, max_magnitude, cluster_size,
 {r('centroid_lat')} AS centroid_lat, {r('centroid_lon')} AS centroid_lon FROM summ""")
def _(t: Tables):
    clustered = t.processed.join(t.labels.filter("cluster_id <> -1").select("id", "cluster_id"), "id")
    return rounded(hazard.cluster_summary(clustered), "avg_magnitude", "centroid_lat", "centroid_lon")


@query("a7_hazard_zones", f"""WITH RECURSIVE {CLUSTERS} SELECT risk_level, {r('avg_magnitude')} AS avg_magnitude, event_count, {r('center_lat')} AS center_lat, {r('center_lon')} AS center_lon,
 CAST(NULL AS VARCHAR) AS boundary_coordinates, CAST(NULL AS DOUBLE) AS area_km2 FROM zones""")
def _(t: Tables):
    return rounded(hazard.hazard_zones(t.clusters), "avg_magnitude", "center_lat", "center_lon")


@query("u4_cluster_list", f"""WITH RECURSIVE {CLUSTERS} SELECT cluster_id, cluster_label, risk_zone, {r('centroid_lat')} AS centroid_lat, {r('centroid_lon')} AS centroid_lon, cluster_size,
 {r('avg_magnitude')} AS avg_magnitude, max_magnitude FROM clus QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY id)=1""")
def _(t: Tables):
    return rounded(hazard.cluster_list(t.clusters), "centroid_lat", "centroid_lon", "avg_magnitude")


@query("t13_majority_risk", f"""WITH RECURSIVE {CLUSTERS}, e AS (SELECT cluster_id, CASE WHEN magnitude>=6.5 THEN 'Extreme' WHEN magnitude>=5.5 THEN 'High' WHEN magnitude>=4.5 THEN 'Moderate' ELSE 'Low' END AS risk_zone FROM clustered)
 SELECT cluster_id, risk_zone AS cluster_risk FROM e GROUP BY 1,2 QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC, risk_zone)=1""")
def _(t: Tables):
    from tremor.functions.classify import cluster_risk

    events = t.processed.join(t.labels.filter("cluster_id <> -1").select("id", "cluster_id"), "id")
    return hazard.majority_risk(events.withColumn("risk_zone", cluster_risk(c("magnitude"))))


@query("zone_ranking", f"""WITH RECURSIVE {LABELS}, j AS (SELECT proc.*, cluster_id FROM proc JOIN labels USING (id) WHERE cluster_id <> -1),
 top AS (SELECT cluster_id, region AS dominant_region FROM j GROUP BY cluster_id, region QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC, region)=1)
 SELECT cluster_id, 'Hazard Zone ' || (cluster_id+1) AS cluster_name, count(*) AS "count", {r('avg(magnitude)')} AS avg_magnitude, max(magnitude) AS max_magnitude,
 {r('avg(depth)')} AS avg_depth, {r('avg(hazard_score)')} AS avg_hazard_score, count(*) FILTER (tsunami=1) AS tsunami_events,
 count(*) FILTER (alert IN ('orange','red')) AS high_alert_events, any_value(dominant_region) AS dominant_region,
 {r('avg(latitude)')} AS latitude_center, {r('avg(longitude)')} AS longitude_center FROM j JOIN top USING (cluster_id) GROUP BY cluster_id""")
def _(t: Tables):
    return rounded(master.zone_ranking(t.catalog), "avg_magnitude", "avg_depth", "avg_hazard_score", "latitude_center", "longitude_center")


@query("ingest_features", f"""WITH {EV} SELECT * EXCLUDE (event_type, user_id) REPLACE ({stamp('time')} AS time, {stamp('updated')} AS updated, regexp_replace(place, '[^a-zA-Z0-9\\s,-]', '', 'g') AS place),
 {REGION} AS indonesian_region, {r('sqrt(pow(latitude+6.2088::DOUBLE,2)+pow(longitude-106.8456::DOUBLE,2))*111')} AS distance_from_jakarta,
 magnitude*magnitude AS magnitude_squared, 'spark_processed' AS processing_stage FROM ev WHERE {VALID}""")
def _(t: Tables):
    rows = rounded(master.ingest(t.catalog), "distance_from_jakarta")
    return rows.withColumns({x: as_text(x) for x in ("time", "updated")})


@query("g4_augmented_ids", f"WITH {EV} SELECT id, magnitude_type, source FROM (SELECT id, magnitude_type, CAST(NULL AS VARCHAR) AS source FROM ev UNION ALL SELECT id || '_spark_aug_' || i, magnitude_type, 'augmented' FROM ev, range(1,3) g(i))")
def _(t: Tables):
    copies = augment(t.catalog, 3, suffix="_spark_aug_", label="augmented")
    return copies.select("id", "magnitude_type", c("data_source").alias("source"))


def _noise(column: str) -> str:
    u, v = (f"(CAST('0x' || substr(md5(id || '/' || i || '/{column}/{k}'), 1, 13) AS BIGINT)+1)/4503599627370496.0::DOUBLE" for k in (84, 85))
    moved = f"{column} + sqrt(-2*ln({u}))*cos(2*pi()*({v}))*(SELECT stddev_samp({column}) FROM ev)*0.001::DOUBLE"
    return f"{r(f'CASE WHEN i=0 THEN {column} ELSE {moved} END')} AS {column}"


@query("g4_augmented_catalog", f"WITH {EV} SELECT CASE WHEN i=0 THEN id ELSE id || '_aug_' || i END AS id, {', '.join(map(_noise, ('latitude', 'longitude', 'depth', 'magnitude')))} FROM ev, range(3) g(i)")
def _(t: Tables):
    return rounded(augment(t.catalog, 3).select("id", "latitude", "longitude", "depth", "magnitude"), "latitude", "longitude", "depth", "magnitude")
