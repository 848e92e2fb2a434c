"""Snapshot-to-snapshot table maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.base import Tables, query
from suite.filters import with_copies
from suite.sql import CLUSTERS, CLUSTER_RISK, COPIES, ENH, PROC, r
from tremor.operators import maintain
from tremor.plans.etl import ENHANCED_COLUMNS
from tremor.plans.master import PROCESSED_COLUMNS

c = F.col


def snapshot(t: Tables):
    return t.enhanced.select(*ENHANCED_COLUMNS)


@query("z1_insert_rows", f"""WITH {ENH} SELECT id, magnitude, region, alert_level FROM enh UNION ALL
 SELECT 'test_' || region, max(magnitude), region, max(alert_level) FROM enh GROUP BY region""")
def _(t: Tables):
    rows = snapshot(t).groupBy("region").agg(F.max("magnitude").alias("magnitude"), F.max("alert_level").alias("alert_level"))
    kept = snapshot(t).select("id", "magnitude", "region", "alert_level")
    after, _ = maintain.insert(kept, rows.withColumn("id", F.concat(F.lit("test_"), "region")))
    return after


@query("z2_insert_if_quiet", f"""WITH {ENH}, q AS (SELECT region, max(magnitude) AS magnitude FROM enh GROUP BY region) SELECT 'quiet_' || region AS id, magnitude FROM q
 WHERE NOT EXISTS (SELECT 1 FROM enh WHERE region='Java' AND magnitude>=6 AND depth_category IN ('Very Shallow','Shallow') AND datetime_local >= (SELECT max(datetime_local) FROM enh) - INTERVAL 24 HOUR)""")
def _(t: Tables):
    as_of = t.enhanced.agg(F.max("datetime_local").alias("m")).scalar()
    rows = snapshot(t).groupBy("region").agg(F.max("magnitude").alias("magnitude")).withColumn("id", F.concat(F.lit("quiet_"), "region"))
    _, added = maintain.insert_unless(snapshot(t).select("id", "magnitude"), rows, maintain.recent_high_risk(t.enhanced, as_of))
    return added


BLURRED = "CASE WHEN tsunami=1 THEN 'Deep' ELSE depth_category END"


@query("z3_fix_depth_category", f"""WITH {ENH}, s AS (SELECT id, depth, {BLURRED} AS depth_category FROM enh)
 SELECT id, CASE WHEN depth>30 AND depth<=70 AND depth_category<>'Shallow' THEN 'Shallow' ELSE depth_category END AS depth_category FROM s""")
def _(t: Tables):
    before = snapshot(t).withColumn("depth_category", F.when(c("tsunami") == 1, "Deep").otherwise(c("depth_category")))
    return maintain.fix_depth_category(before)[0].select("id", "depth_category")


@query("z3_fixed_rows", f"WITH {ENH} SELECT id, 'Shallow' AS depth_category FROM enh WHERE depth>30 AND depth<=70 AND tsunami=1")
def _(t: Tables):
    before = snapshot(t).withColumn("depth_category", F.when(c("tsunami") == 1, "Deep").otherwise(c("depth_category")))
    return maintain.fix_depth_category(before)[1].select("id", "depth_category")


@query("z4_rename_place", f"WITH {ENH} SELECT id, replace(place,'signup','station') AS place FROM enh")
def _(t: Tables):
    return maintain.rename_place(snapshot(t), "signup", "station")[0].select("id", "place")


@query("z5_round_depth", f"WITH {ENH} SELECT id, CASE WHEN region='Sumatra' THEN {r('depth', 2)} ELSE depth END AS depth FROM enh")
def _(t: Tables):
    return maintain.round_depth(snapshot(t))[0].select("id", "depth")


@query("z6_delete_duplicates", f"WITH {ENH}, {COPIES} SELECT id, region FROM copies QUALIFY row_number() OVER (PARTITION BY {', '.join(maintain.CONTENT)} ORDER BY id)=1")
def _(t: Tables):
    return maintain.delete_duplicates(with_copies(t).select(*ENHANCED_COLUMNS))[0].select("id", "region")


@query("z6_deleted_duplicates", f"WITH {ENH}, {COPIES} SELECT id FROM copies QUALIFY row_number() OVER (PARTITION BY {', '.join(maintain.CONTENT)} ORDER BY id)>1")
def _(t: Tables):
    return maintain.delete_duplicates(with_copies(t).select(*ENHANCED_COLUMNS))[1].select("id")


OLD = "magnitude<4.2 AND hazard_score<9 AND datetime_local < (SELECT max(datetime_local) FROM enh) - INTERVAL 7 DAY"


@query("z7_delete_old_minor", f"WITH {ENH} SELECT id FROM enh WHERE NOT coalesce({OLD}, false)")
def _(t: Tables):
    as_of = t.enhanced.agg(F.max("datetime_local").alias("m")).scalar()
    return maintain.delete_old_minor(snapshot(t), as_of)[0].select("id")


@query("z8_delete_invalid", f"""WITH {ENH} SELECT id FROM enh WHERE NOT coalesce(latitude<-90 OR latitude>90 OR longitude<-180 OR longitude>180 OR magnitude<0 OR magnitude>10
 OR depth*1.2::DOUBLE<0 OR depth*1.2::DOUBLE>800 OR hazard_score<0 OR hazard_score>50 OR intensity_score<0 OR intensity_score>30 OR region IS NULL OR region='' OR place IS NULL OR place='', false)""")
def _(t: Tables):
    return maintain.delete_invalid(snapshot(t).withColumn("depth", c("depth") * 1.2))[0].select("id")


@query("z9_refresh_risk_zones", f"WITH RECURSIVE {CLUSTERS} SELECT id, {CLUSTER_RISK} AS risk_zone FROM clus")
def _(t: Tables):
    blank = t.clusters.withColumn("risk_zone", F.lit("Unknown"))
    return maintain.refresh_risk_zones(blank)[0].select("id", "risk_zone")


@query("z10_rename_columns", f"WITH RECURSIVE {CLUSTERS} SELECT earthquake_id, classified_risk_zone, classification_confidence FROM cls")
def _(t: Tables):
    old = t.classifications.withColumnsRenamed({"classified_risk_zone": "predicted_risk_zone", "classification_confidence": "prediction_confidence"})
    names = {"predicted_risk_zone": "classified_risk_zone", "prediction_confidence": "classification_confidence"}
    return maintain.rename_columns(old, names).select("earthquake_id", "classified_risk_zone", "classification_confidence")


@query("z11_replace_table", f"WITH {ENH} SELECT id, region FROM enh WHERE region <> 'Other'")
def _(t: Tables):
    from tremor.sources.sinks import read_stored, replace_table, scratch_path

    path = scratch_path(t.catalog, "replaced")
    replace_table(snapshot(t).select("id", "region"), path)
    replace_table(read_stored(t.spark, path, "table").filter("region <> 'Other'"), path)
    return read_stored(t.spark, path, "table")


COLUMNS = list(zip(PROCESSED_COLUMNS, ["string", "double", "double", "double", "double", "timestamp", "string", "double", "double", "string", "string", "string", "int", "string"]))


@query("z12_describe_columns", f"WITH {PROC} " + " UNION ALL ".join(
    f"SELECT {i} AS position, '{n}' AS column_name, '{k}' AS data_type, count({n}) AS filled FROM proc" for i, (n, k) in enumerate(COLUMNS, 1)))
def _(t: Tables):
    """Column types next to the share of filled values, read from the table itself."""
    columns = maintain.describe_columns(t.processed)
    filled = t.processed.agg(*[F.struct(F.lit(x).alias("column_name"), F.count(x).alias("filled")).alias(x) for x in t.processed.columns])
    return columns.join(filled.select(F.explode(F.array(*t.processed.columns)).alias("x")).select("x.*"), "column_name")
