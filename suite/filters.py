"""Filters, projections, sorts, limits, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.base import Tables, query, stamp
from suite.sql import COPIES, ENH, EV, EVAL, LABELS, PROC, REGION, VALID, stamp as sql_stamp
from tremor.operators import dedup, filters
from tremor.operators.charts import marker_sample, points
from tremor.operators.maintain import CONTENT
from tremor.operators.ranking import batches
from tremor.plans import evaluation, served
from tremor.schemas import CATALOG

c = F.col


@query("p1_valid_events", f"WITH {EV} SELECT id, latitude, longitude, magnitude, depth FROM ev WHERE {VALID}")
def _(t: Tables):
    return filters.valid_events(t.catalog).select("id", "latitude", "longitude", "magnitude", "depth")


@query("p2_valid_stream_events", f"WITH {EV} SELECT id FROM ev WHERE magnitude>0 AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180")
def _(t: Tables):
    return filters.valid_stream_events(t.catalog).select("id")


@query("p3_select_catalog", f"""WITH {EV} SELECT id, longitude FROM ev WHERE time >= TIMESTAMP '2024-01-05' AND time <= TIMESTAMP '2024-01-20'
 AND magnitude >= 3.5 AND (longitude >= 120 OR longitude <= -60) AND latitude BETWEEN -10 AND 50""")
def _(t: Tables):
    return filters.select_catalog(t.catalog, "2024-01-05", "2024-01-20", 3.5, (120, -60, -10, 50)).select("id", "longitude")


@query("p3_select_newest", f"WITH {EV} SELECT id FROM ev WHERE magnitude >= 4 ORDER BY time DESC, id LIMIT 200")
def _(t: Tables):
    return filters.select_catalog(t.catalog, min_magnitude=4.0, limit=200).select("id")


@query("p9_select_existing", f"WITH {EV} SELECT id AS event, magnitude FROM ev")
def _(t: Tables):
    return filters.select_columns(t.catalog, ["id", "magnitude", "not_there"]).withColumnsRenamed({"id": "event"})


@query("p10_interactive_filter", f"""WITH {PROC} SELECT id FROM (SELECT id, region, magnitude, CASE WHEN magnitude>=7 OR (magnitude>=6 AND depth<50) THEN 'Extreme'
 WHEN magnitude>=5.5 OR (magnitude>=5 AND depth<70) THEN 'High' WHEN magnitude>=4 THEN 'Moderate' ELSE 'Low' END AS risk_zone FROM proc)
 WHERE magnitude>=3.2 AND risk_zone IN ('High','Extreme')""")
def _(t: Tables):
    from tremor.functions.classify import event_risk

    rows = t.processed.withColumn("risk_zone", event_risk(c("magnitude"), c("depth")))
    return filters.interactive_filter(rows, 3.2, ["High", "Extreme"], []).select("id")


@query("p11_optional_filters", f"WITH {PROC} SELECT id FROM proc WHERE hazard_score >= 4")
def _(t: Tables):
    absent = None
    return filters.optional_filters(
        t.processed, (4.0, c("hazard_score") >= 4.0), (absent, c("region") == F.lit(absent))
    ).select("id")


@query("p12_good_quality", f"WITH {ENH} SELECT id, data_quality FROM enh WHERE data_quality='Good'")
def _(t: Tables):
    return filters.good_quality(t.catalog).select("id", "data_quality")


@query("p13_quartile_fences", f"""WITH {ENH}, q AS (SELECT quantile_cont(magnitude,0.25) AS q1, quantile_cont(magnitude,0.75) AS q3 FROM enh WHERE data_quality='Good')
 SELECT id, magnitude FROM enh, q WHERE data_quality='Good' AND magnitude >= q1-1.5*(q3-q1) AND magnitude <= q3+1.5*(q3-q1)""")
def _(t: Tables):
    return filters.within_quartile_fences(filters.good_quality(t.catalog)).select("id", "magnitude")


INVALID = """(latitude < -90 OR latitude > 90) OR (longitude < -180 OR longitude > 180) OR magnitude < 0 OR magnitude > 10 OR depth < 0 OR depth > 700
 OR hazard_score < 0 OR hazard_score > 50 OR intensity_score < 0 OR intensity_score > 30 OR region IS NULL OR region = '' OR place IS NULL OR place = ''"""


@query("p14_invalid_records", f"WITH {ENH} SELECT id FROM (SELECT * REPLACE (depth*1.3::DOUBLE AS depth, CASE WHEN tsunami=1 THEN '' ELSE place END AS place) FROM enh) WHERE {INVALID.replace('depth > 700', 'depth > 800')}")
def _(t: Tables):
    """A catalog with depths out of range and places left blank."""
    spoilt = t.enhanced.withColumns({"depth": c("depth") * 1.3, "place": F.when(c("tsunami") == 1, "").otherwise(c("place"))})
    return spoilt.filter(filters.invalid_record()).select("id")


@query("p15_magnitude_range", f"WITH {ENH} SELECT id, magnitude, {sql_stamp('datetime_local')} AS datetime_local FROM enh WHERE magnitude BETWEEN 4.0 AND 5.0 ORDER BY enh.datetime_local DESC, id LIMIT 5")
def _(t: Tables):
    found = filters.latest(t.enhanced, c("magnitude").between(4.0, 5.0))
    return found.select("id", "magnitude", stamp("datetime_local").alias("datetime_local"))


@query("p15_region_box", f"WITH {ENH} SELECT id, depth_category FROM enh WHERE longitude BETWEEN 100 AND 110 AND latitude BETWEEN -5 AND 5 AND depth_category='Shallow' ORDER BY datetime_local DESC, id LIMIT 5")
def _(t: Tables):
    box = c("longitude").between(100, 110) & c("latitude").between(-5, 5) & (c("depth_category") == "Shallow")
    return filters.latest(t.enhanced, box).select("id", "depth_category")


@query("p16_labelled", f"WITH {EV} SELECT id, alert AS risk_zone FROM ev WHERE alert IS NOT NULL AND alert <> 'Unknown'")
def _(t: Tables):
    return filters.labelled(t.catalog.select("id", c("alert").alias("risk_zone")))


@query("p17_without_noise", f"WITH RECURSIVE {LABELS} SELECT id, cluster_id FROM labels WHERE cluster_id <> -1")
def _(t: Tables):
    return filters.without_noise(t.labels).select("id", "cluster_id")


@query("p18_provenance", f"WITH {EV} SELECT id, 'CATALOG' AS data_source, 'spark_processed' AS processing_stage, year(time)::INTEGER AS year FROM ev")
def _(t: Tables):
    return filters.with_provenance(t.catalog, "CATALOG", "spark_processed", F.year("time")).select(
        "id", "data_source", "processing_stage", "year")


@query("p19_normalise_schema", f"WITH {EV} SELECT id, magnitude, CAST(NULL AS DOUBLE) AS gap, CAST(NULL AS VARCHAR) AS net FROM ev")
def _(t: Tables):
    narrow = t.catalog.select("id", "time", "magnitude")
    return filters.normalise_schema(narrow, CATALOG).select("id", "magnitude", "gap", "net")


# Sorts, limits, samples.
EVAL_COLUMNS = "id, magnitude, place, latitude, longitude, depth, geographic_zone, risk_score"


@query("k1_top_magnitude", f"WITH {EVAL} SELECT {EVAL_COLUMNS} FROM eva WHERE magnitude IS NOT NULL ORDER BY magnitude DESC, id LIMIT 10")
def _(t: Tables):
    return evaluation.top_magnitude(t.evaluated)


@query("k5_viewing_rows", f"WITH {EVAL} SELECT id, magnitude, earthquake_cluster FROM eva WHERE magnitude IS NOT NULL ORDER BY id LIMIT 700")
def _(t: Tables):
    return served.viewing_rows(t.evaluated, 700).select("id", "magnitude", "earthquake_cluster")


@query("k6_marker_sample", f"WITH {PROC} SELECT id, magnitude FROM proc ORDER BY md5(id || '/42'), id LIMIT 500")
def _(t: Tables):
    return marker_sample(t.processed).select("id", "magnitude")


@query("k8_time_ordered", f"WITH {EV} SELECT {sql_stamp('time')} AS datetime_local, magnitude FROM ev WHERE time IS NOT NULL AND magnitude IS NOT NULL ORDER BY time")
def _(t: Tables):
    return points(t.catalog, ["time", "magnitude"], "time").select(stamp("time").alias("datetime_local"), "magnitude")


@query("k9_batches", f"WITH {EV} SELECT id, (row_number() OVER (ORDER BY id) - 1)//1000 AS batch FROM ev")
def _(t: Tables):
    return batches(t.catalog.select("id"), ["id"], 1000)


@query("k10_shallowest_shallow", f"WITH {ENH} SELECT id, depth FROM enh WHERE depth_category='Shallow' ORDER BY depth, id LIMIT 10")
def _(t: Tables):
    return filters.shallowest(t.enhanced, c("depth_category") == "Shallow").select("id", "depth")


@query("k10_shallowest_by_place", f"WITH {ENH} SELECT id, place FROM enh WHERE place LIKE '%signup%' ORDER BY depth, id LIMIT 10")
def _(t: Tables):
    return filters.shallowest(t.enhanced, c("place").contains("signup")).select("id", "place")


@query("k10_shallowest_sumatra", f"WITH {ENH} SELECT id, depth FROM enh WHERE region='Sumatra' ORDER BY depth, id LIMIT 10")
def _(t: Tables):
    return filters.shallowest(t.enhanced, c("region") == "Sumatra").select("id", "depth")


# Set operations and deduplication.
@query("u1_union_all", f"WITH {EV} SELECT id, magnitude, 'catalog' AS batch FROM ev UNION ALL SELECT id, magnitude, 'java' FROM (SELECT *, {REGION} AS region FROM ev) WHERE region='Java'")
def _(t: Tables):
    from tremor.functions.classify import region

    java = t.catalog.filter(region(c("longitude"), c("latitude")) == "Java")
    return dedup.union_all([t.catalog.withColumn("batch", F.lit("catalog")), java.withColumn("batch", F.lit("java"))]).select(
        "id", "magnitude", "batch")


@query("u2_except_distinct", f"WITH {EV} SELECT felt, alert FROM ev EXCEPT SELECT felt, alert FROM ev WHERE magnitude >= 5")
def _(t: Tables):
    rows = t.catalog
    return dedup.except_distinct(rows.select("felt", "alert"), rows.filter("magnitude >= 5").select("felt", "alert"))


@query("u2_new_since", f"WITH {EV} SELECT id FROM ev WHERE time > (SELECT max(time) FROM ev) - INTERVAL 7 DAY")
def _(t: Tables):
    from tremor.workspace import materialise

    as_of = t.catalog.agg(F.max("time").alias("m")).scalar()
    snapshot = materialise(t.catalog.filter(c("time") <= as_of - F.expr("INTERVAL 7 DAYS")).select("id"), "snapshot")
    return dedup.new_since(t.catalog, snapshot).select("id")


@query("u3_latest_per_key", f"WITH {EV} SELECT felt AS swarm, id, magnitude FROM ev QUALIFY row_number() OVER (PARTITION BY felt ORDER BY updated DESC, id DESC)=1")
def _(t: Tables):
    rows = t.catalog.withColumn("swarm", c("felt"))
    return dedup.latest_per_key(rows, ["swarm"], ["updated", "id"]).select("swarm", "id", "magnitude")


@query("u5_distinct_ids", f"WITH {EV} SELECT DISTINCT id FROM ev")
def _(t: Tables):
    return t.catalog.select("id").distinct()


def with_copies(t: Tables):
    """The enhanced catalog, in which every seventh event has copies under two other ids."""
    again = t.enhanced.filter("event_id % 7 = 0").withColumn("id", F.explode(F.array(F.concat(F.lit("a"), "id"), F.concat("id", F.lit("b")))))
    return t.enhanced.unionByName(again)


@query("w1_duplicate_rows", f"WITH {ENH}, {COPIES} SELECT id, row_number() OVER (PARTITION BY {', '.join(CONTENT)} ORDER BY id) AS rn FROM copies QUALIFY rn > 1")
def _(t: Tables):
    return dedup.duplicates(with_copies(t).select("id", *CONTENT), CONTENT).select("id", "rn")
