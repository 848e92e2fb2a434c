"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.base import Tables, query, rounded, stamp
from suite.sql import CLUSTERS, ENH, FEAT, LABELS, PROC, r, stamp as sql_stamp
from tremor.learning.models import trainable, training_rows
from tremor.operators import dedup, hazard, maintain, stats
from tremor.operators.digests import narrowed_join
from tremor.operators.density import with_cell_counts, with_grid_cells
from tremor.plans import served

c = F.col


@query("j1_zone_join", f"""WITH {FEAT}, z AS (SELECT geographic_zone, avg(magnitude) AS m, count(*) AS n FROM feat GROUP BY 1)
 SELECT id, geographic_zone, {r('m')} AS regional_avg_magnitude, n AS regional_earthquake_count FROM feat LEFT JOIN z USING (geographic_zone)""")
def _(t: Tables):
    joined = stats.attach_zone_stats(t.features)
    return rounded(joined, "regional_avg_magnitude").select("id", "geographic_zone", "regional_avg_magnitude", "regional_earthquake_count")


@query("j2_month_join", f"""WITH {FEAT}, z AS (SELECT year, month, avg(magnitude) AS m FROM feat GROUP BY 1,2)
 SELECT id, year, month, {r('m')} AS monthly_regional_avg_magnitude FROM feat LEFT JOIN z USING (year, month)""")
def _(t: Tables):
    joined = stats.attach_monthly_stats(t.features)
    return rounded(joined, "monthly_regional_avg_magnitude").select("id", "year", "month", "monthly_regional_avg_magnitude")


@query("m33_relative_magnitudes", f"""WITH {FEAT} SELECT id, {r('magnitude - avg(magnitude) OVER (PARTITION BY geographic_zone)', 9)} AS magnitude_vs_regional_avg,
 {r('magnitude - avg(magnitude) OVER (PARTITION BY year, month)', 9)} AS magnitude_vs_monthly_avg FROM feat""")
def _(t: Tables):
    names = ("magnitude_vs_regional_avg", "magnitude_vs_monthly_avg")
    return rounded(stats.with_relative_magnitudes(t.features), *names, digits=9).select("id", *names)


@query("j3_cell_join", f"WITH {PROC} SELECT id, lat_grid, lon_grid, grid_count FROM dens")
def _(t: Tables):
    return with_cell_counts(with_grid_cells(t.processed)).select("id", "lat_grid", "lon_grid", "grid_count")


@query("j4_cluster_join", f"""WITH RECURSIVE {CLUSTERS} SELECT id, cluster_id, cluster_label, {r('avg_magnitude')} AS avg_magnitude, max_magnitude, cluster_size,
 {r('centroid_lat')} AS centroid_lat, {r('centroid_lon')} AS centroid_lon FROM clus""")
def _(t: Tables):
    clustered = t.processed.join(t.labels.filter("cluster_id <> -1").select("id", "cluster_id"), "id")
    joined = hazard.attach_cluster_summary(clustered.select("id", "cluster_id", "magnitude", "latitude", "longitude"))
    return rounded(joined, "avg_magnitude", "centroid_lat", "centroid_lon").select(
        "id", "cluster_id", "cluster_label", "avg_magnitude", "max_magnitude", "cluster_size", "centroid_lat", "centroid_lon")


@query("j5_training_join", f"""WITH RECURSIVE {CLUSTERS} SELECT proc.id, magnitude, risk_zone, cluster_size FROM proc JOIN clus USING (id)
 WHERE risk_zone IS NOT NULL AND risk_zone <> 'Unknown'""")
def _(t: Tables):
    return training_rows(t.processed, t.clusters).select("id", "magnitude", "risk_zone", "cluster_size")


@query("j6_event_summary", f"""WITH RECURSIVE {CLUSTERS} SELECT proc.id, {sql_stamp('time')} AS time, region, risk_zone, cluster_id, cluster_label, classified_risk_zone, classification_confidence
 FROM proc LEFT JOIN clus USING (id) LEFT JOIN cls ON proc.id = cls.earthquake_id""")
def _(t: Tables):
    summary = served.event_summary(t.processed, t.clusters, t.classifications)
    return summary.withColumn("time", stamp("time")).select(
        "id", "time", "region", "risk_zone", "cluster_id", "cluster_label", "classified_risk_zone", "classification_confidence")


NEW_EVENT = "SELECT 'new_' || region AS id, region, max(magnitude) AS magnitude FROM enh GROUP BY region"


@query("j7_insert_unless_exists", f"""WITH {ENH} SELECT id, magnitude FROM enh UNION ALL SELECT id, magnitude FROM ({NEW_EVENT})
 WHERE NOT EXISTS (SELECT 1 FROM enh WHERE region='Java' AND magnitude>=6 AND depth_category IN ('Very Shallow','Shallow') AND datetime_local >= (SELECT max(datetime_local) FROM enh) - INTERVAL 24 HOUR)""")
def _(t: Tables):
    as_of = t.enhanced.agg(F.max("datetime_local").alias("m")).scalar()
    new = t.enhanced.groupBy("region").agg(F.max("magnitude").alias("magnitude")).withColumn("id", F.concat(F.lit("new_"), "region"))
    blocker = maintain.recent_high_risk(t.enhanced, as_of)
    after, _ = maintain.insert_unless(t.enhanced.select("id", "magnitude"), new, blocker)
    return after


@query("j8_in_subquery", f"""WITH {ENH} SELECT id, region FROM enh WHERE id IN (SELECT id FROM enh QUALIFY row_number() OVER (PARTITION BY region, depth_category ORDER BY id) = 1)""")
def _(t: Tables):
    firsts = dedup.without_duplicates(t.enhanced, ["region", "depth_category"]).select("id")
    return t.enhanced.join(firsts, "id", "left_semi").select("id", "region")


@query("j9_core_points", f"WITH RECURSIVE {LABELS} SELECT id, is_core FROM labels")
def _(t: Tables):
    return t.labels.select("id", "is_core")


@query("j10_missing_parents", f"WITH {PROC} SELECT id FROM ev WHERE id NOT IN (SELECT id FROM proc WHERE depth_category IS NOT NULL)")
def _(t: Tables):
    from tremor.workspace import materialise

    parents = materialise(t.processed.filter("depth_category is not null").select("id"), "parents")
    return dedup.missing_parents(t.catalog, parents, "id").select("id")


def scan(t: Tables, name: str):
    return t.spark.read.parquet(f"{t.folder}/{name}.parquet")


@query("j8_narrowed_in", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)")
def _(t: Tables):
    """Orders with a large line; the keys of the smaller side keep the other out of the shuffle."""
    large = scan(t, "lineitem").filter("l_quantity >= 49").select(c("l_orderkey").alias("o_orderkey"))
    return narrowed_join(scan(t, "orders").select("o_orderkey", "o_totalprice"), large, ["o_orderkey"], "left_semi", limit=0)


@query("j10_narrowed_missing", "SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice >= 100000)")
def _(t: Tables):
    """Customers without a dear order: the smaller side has the rows, the larger side the references."""
    dear = scan(t, "orders").filter("o_totalprice >= 100000")
    return dedup.missing_parents(scan(t, "customer").select("c_custkey", "c_acctbal"), dear, "c_custkey", "o_custkey", limit=0)


@query("j10_narrowed_lines", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_totalprice < 50000)")
def _(t: Tables):
    """Lines of orders outside a small set: the larger side has the rows, and most of them are kept without a shuffle."""
    cheap = scan(t, "orders").filter("o_totalprice < 50000")
    return dedup.missing_parents(scan(t, "lineitem").select("l_orderkey", "l_linenumber"), cheap, "l_orderkey", "o_orderkey", limit=0)


@query("k2_labelled_events", f"""WITH RECURSIVE {CLUSTERS} SELECT proc.id, magnitude, region, risk_zone, cluster_id FROM proc JOIN clus USING (id)
 WHERE risk_zone IS NOT NULL ORDER BY magnitude DESC, proc.id LIMIT 100""")
def _(t: Tables):
    summary = served.event_summary(t.processed, t.clusters, t.classifications, latest_only=True)
    return served.labelled_events(summary).select("id", "magnitude", "region", "risk_zone", "cluster_id")


@query("k3_classifications", f"WITH RECURSIVE {CLUSTERS} SELECT * FROM cls WHERE classification_confidence >= 0.9 ORDER BY classification_confidence DESC, earthquake_id, model_version LIMIT 1000")
def _(t: Tables):
    return served.classifications(t.classifications, 1000, 0.9)


@query("k4_hazard_zones", f"""WITH RECURSIVE {CLUSTERS} SELECT risk_level, {r('avg_magnitude')} AS avg_magnitude, event_count, {r('center_lat')} AS center_lat, {r('center_lon')} AS center_lon,
 '{{}}' AS boundary_coordinates FROM zones ORDER BY event_count DESC, risk_level LIMIT 100""")
def _(t: Tables):
    return rounded(served.hazard_zones(t.zones), "avg_magnitude", "center_lat", "center_lon")


@query("l18_classification_rows", f"WITH RECURSIVE {CLUSTERS} SELECT * FROM cls")
def _(t: Tables):
    return hazard.classification_rows(t.clusters)


@query("l19_training_guard", f"WITH RECURSIVE {CLUSTERS} SELECT count(*) AS samples, count(DISTINCT risk_zone) AS classes, count(*)>0 AND count(DISTINCT risk_zone)>=2 AS trainable FROM clus")
def _(t: Tables):
    return trainable(training_rows(t.processed, t.clusters))
