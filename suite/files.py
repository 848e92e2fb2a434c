"""Readers and writers: every query writes the catalog in some form and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.base import Tables, query, settled, stamp
from suite.sql import CLUSTERS, ENH, EV, FEAT, PROC, r, stamp as sql_stamp
from tremor.operators import maintain, stats
from tremor.operators.filters import require_columns
from tremor.plans.etl import ENHANCED_COLUMNS
from tremor.plans.master import store
from tremor.schemas import CATALOG
from tremor.sources import files, geojson, sinks, windows

c = F.col
CATALOG_COLUMNS = [f.name for f in CATALOG.fields]
SHOWN = ["id", "latitude", "longitude", "depth", "magnitude", "place", "felt", "alert"]


def catalog(t: Tables):
    return t.catalog.select(*CATALOG_COLUMNS)


@query("s1_flatten_features", f"WITH {EV} SELECT {', '.join(SHOWN)}, epoch_us(time)//1000 AS time_ms FROM ev")
def _(t: Tables):
    path = sinks.scratch_path(t.catalog, "features") + ".json"
    collections = geojson.to_features(t.catalog).select(F.array(F.struct("id", "properties", "geometry")).alias("features"))
    collections.write.json(path)
    flat = geojson.flatten_collections(geojson.read_collections(t.spark, path, one_per_file=False))
    return flat.select(*SHOWN, F.unix_millis("time").alias("time_ms"))


RAW_TEXT = {
    "id": "id", "time": "cast(unix_millis(time) as string)", "latitude": "cast(latitude as string)",
    "longitude": "cast(longitude as string)", "depth": "cast(depth as string)",
    "magnitude": "if(event_kind = 'signup', 'n/a', cast(magnitude as string))", "magnitude_type": "magnitude_type",
    "place": "place", "significance": "cast(sig as string)", "alert": "alert", "tsunami": "cast(tsunami as string)",
    "year": "cast(year(time) as string)", "extraction_timestamp": "cast(unix_millis(time) as string)", "data_source": "'file'",
}


def raw_text(t: Tables):
    marked = t.catalog.withColumn("event_kind", F.element_at(F.split("place", " "), -1))
    return marked.selectExpr(*[f"{e} as {n}" for n, e in RAW_TEXT.items()])


@query("s2_typed_load", f"WITH {EV} SELECT id, {sql_stamp('time')} AS time, latitude, depth, magnitude, sig AS significance, year(time)::INTEGER AS year FROM ev WHERE event_type <> 'signup'")
def _(t: Tables):
    good, _ = files.load_raw(raw_text(t))
    return good.select("id", stamp("time").alias("time"), "latitude", "depth", "magnitude", "significance", "year")


@query("s2_rejected_records", f"WITH {EV} SELECT id, 'n/a' AS magnitude FROM ev WHERE event_type = 'signup'")
def _(t: Tables):
    _, rejects = files.load_raw(raw_text(t))
    return rejects.select("id", "magnitude")


def _round_trip(kind: str) -> None:
    @query(f"s3_read_{kind}", f"WITH {EV} SELECT {', '.join(SHOWN)}, {sql_stamp('time')} AS time FROM ev")
    def run(t: Tables):
        path = sinks.scratch_path(t.catalog, "catalog") + f".{kind}"
        writer = catalog(t).write
        (writer.option("header", True).csv if kind == "csv" else getattr(writer, kind))(path)
        return files.read_catalog(t.spark, path).select(*SHOWN, stamp("time").alias("time"))


for _kind in ("parquet", "csv", "json"):
    _round_trip(_kind)


@query("s3_read_reordered_csv", f"WITH {EV} SELECT {', '.join(SHOWN)}, CAST(NULL AS DOUBLE) AS gap, {sql_stamp('time')} AS time FROM ev")
def _(t: Tables):
    """Another column order, a column too many, and one missing."""
    path = sinks.scratch_path(t.catalog, "wide") + ".csv"
    sinks.write_csv(catalog(t).drop("gap").select("magnitude", F.lit("x,y").alias("extra"), "place", "time", "longitude", "latitude", "id", "depth", "alert", "felt"), path)
    return files.read_catalog(t.spark, path).select(*SHOWN, "gap", stamp("time").alias("time"))


@query("s4_read_two_layouts", f"WITH {EV} SELECT id, {sql_stamp('time')} AS time, latitude, longitude, depth, CASE WHEN alert='red' THEN magnitude END AS magnitude, place FROM ev")
def _(t: Tables):
    """Two files with different column orders, one of them without magnitudes."""
    path = sinks.scratch_path(t.catalog, "layouts") + ".csv"
    rows = t.catalog.withColumn("time", F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    red = c("alert").eqNullSafe("red")
    sinks.write_csv(rows.filter(red).select("place", "longitude", "latitude", "id", "time", "magnitude", "depth"), path)
    rows.filter(~red).select("id", "time", "latitude", "longitude", "depth", "place").write.mode("append").option("header", True).csv(path)
    return files.read_evaluation_csv(t.spark, path).withColumn("time", stamp("time"))


def evaluation_csv(t: Tables) -> str:
    path = sinks.scratch_path(t.catalog, "evaluation") + ".csv"
    sinks.write_csv(t.catalog.select("net", "id", F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"), "latitude", "longitude", "depth", "magnitude", "place", "gap"), path)
    return path


@query("s4_read_column_subset", f"WITH {EV} SELECT id, {sql_stamp('time')} AS time, latitude, longitude, depth, magnitude, place FROM ev")
def _(t: Tables):
    return files.read_evaluation_csv(t.spark, evaluation_csv(t)).withColumn("time", stamp("time"))


@query("s5_required_columns", f"WITH {PROC} SELECT count(*) AS events FROM proc")
def _(t: Tables):
    needed = ["id", "latitude", "longitude", "magnitude", "depth", "spatial_density", "hazard_score"]
    return require_columns(t.processed, needed).agg(F.count(F.lit(1)).alias("events"))


@query("s6_read_text_catalog", f"WITH {EV} SELECT id, {sql_stamp('time')} AS time, latitude, magnitude, CAST(NULL AS DOUBLE) AS place FROM ev")
def _(t: Tables):
    read = files.read_text_catalog(t.spark, evaluation_csv(t), ["latitude", "longitude", "depth", "magnitude", "place"], ["time"])
    return read.select("id", stamp("time").alias("time"), "latitude", "magnitude", "place")


@query("s7_table_scan", f"WITH {PROC} SELECT id, latitude, longitude, magnitude, depth FROM proc WHERE magnitude >= 4")
def _(t: Tables):
    t.processed.createOrReplaceTempView("earthquakes_processed")
    return files.read_table(t.spark, "earthquakes_processed").filter("magnitude >= 4").select("id", "latitude", "longitude", "magnitude", "depth")


@query("s8_write_csv", f"WITH {FEAT} SELECT geographic_zone, count(*) AS earthquake_count, {r('avg(magnitude)')} AS avg_magnitude FROM feat GROUP BY 1")
def _(t: Tables):
    path = sinks.scratch_path(t.catalog, "zone-stats") + ".csv"
    small = stats.zone_stats(t.features).select("geographic_zone", "earthquake_count", settled(c("avg_magnitude")).alias("avg_magnitude"))
    sinks.write_csv(small, path, single_file=True)
    return t.spark.read.schema(small.schema).option("header", True).csv(path)


@query("s9_write_parquet", f"WITH {PROC} SELECT id, region, magnitude FROM proc")
def _(t: Tables):
    path = sinks.scratch_path(t.catalog, "events")
    out = t.processed.select("id", "region", "magnitude")
    sinks.write_parquet(out, path)
    return t.spark.read.schema(out.schema).parquet(path)


@query("s10_write_formats", f"WITH {EV} SELECT count(*) AS total_records, {sql_stamp('min(time)')} AS first_time, {sql_stamp('max(time)')} AS last_time, true AS sized, {len(CATALOG_COLUMNS)} AS features FROM ev")
def _(t: Tables):
    about = sinks.write_formats(catalog(t), sinks.scratch_path(t.catalog, "formats"), ["events"])
    return about.select(
        "total_records", stamp("first_time").alias("first_time"), stamp("last_time").alias("last_time"),
        ((c("parquet_bytes") > 0) & (c("csv_bytes") > c("parquet_bytes")) & (c("json_bytes") > c("csv_bytes"))).alias("sized"),
        F.size("features_included").alias("features"))


@query("s11_relational_columns", f"WITH {FEAT} SELECT id, magnitude, place, longitude, latitude, depth, felt, cdi, mmi, alert_standardized, tsunami, sig, year, month, day, hour, magnitude_category, depth_category_detailed, geographic_zone FROM feat")
def _(t: Tables):
    """The database writer without a reachable database: its column projection and Parquet fallback."""
    path = sinks.scratch_path(t.catalog, "fallback")
    out = t.features.select(*[x for x in sinks.RELATIONAL_COLUMNS if x in t.features.columns])
    written = sinks.write_jdbc(out, "events", "jdbc:none://nowhere", {}, fallback=path)
    if written:
        raise AssertionError("there is no database to write to")
    return t.spark.read.schema(out.schema).parquet(path).drop("time", "risk_score", "ring_of_fire_distance", "energy_release_log", "population_impact_estimate", "tectonic_activity_score")


@query("s13_refresh_from_itself", f"WITH {PROC} SELECT id, region FROM proc WHERE region <> 'Other'")
def _(t: Tables):
    """A table replaced by a part of itself; a refresh that breaks a reference changes nothing."""
    path = sinks.scratch_path(t.catalog, "stored")
    sinks.refresh_tables({"events": t.processed.select("id", "region")}, path)
    kept = sinks.read_stored(t.spark, path, "events").filter("region <> 'Other'")
    sinks.refresh_tables({"events": kept, "regions": kept.select("region").distinct()}, path, (("events", "region", "regions", "region"),))
    try:
        sinks.refresh_tables({"events": t.processed.select("id", "region"), "regions": kept.select("region").limit(1)}, path, (("events", "region", "regions", "region"),))
    except ValueError:
        return sinks.read_stored(t.spark, path, "events")
    raise AssertionError("a broken reference went unnoticed")


@query("s12_append_aligned", f"WITH {EV} SELECT id, magnitude, place FROM ev UNION ALL SELECT id, magnitude, CAST(NULL AS VARCHAR) FROM ev WHERE magnitude >= 5")
def _(t: Tables):
    """Appending a batch without a column of the target, aligned to the target's schema first."""
    from tremor.operators.filters import normalise_schema

    path = sinks.scratch_path(t.catalog, "appended")
    first = t.catalog.select("id", "magnitude", "place")
    sinks.write_parquet(first, path)
    later = t.catalog.filter("magnitude >= 5").select("magnitude", "id", F.current_timestamp().alias("processed_at"))
    normalise_schema(later, first.schema).write.mode("append").parquet(path)
    return t.spark.read.schema(first.schema).parquet(path)


@query("s13_refresh_tables", f"WITH {PROC} SELECT 'earthquakes_processed' AS table_name, count(*) AS \"rows\" FROM proc UNION ALL SELECT 'regions', count(DISTINCT region) FROM proc")
def _(t: Tables):
    return sinks.refresh_tables(
        {"earthquakes_processed": t.processed, "regions": t.processed.select("region").distinct()},
        sinks.scratch_path(t.catalog, "version"))


@query("s14_append_by_month", f"WITH {ENH} SELECT strftime(datetime_local, '%Y-%m') AS month_batch, count(*) AS events, max(magnitude) AS max_magnitude FROM enh GROUP BY 1")
def _(t: Tables):
    path = sinks.scratch_path(t.catalog, "months")
    sinks.append_by_month(t.enhanced.select(*ENHANCED_COLUMNS), path)
    read = t.spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", False).parquet(path)
    return read.groupBy(c("month_batch").cast("string").alias("month_batch")).agg(
        F.count(F.lit(1)).alias("events"), F.max("magnitude").alias("max_magnitude"))


@query("s17_write_report", f"WITH {PROC} SELECT count(*) AS total_earthquakes, max(magnitude) AS max_magnitude, count(DISTINCT region) AS unique_regions FROM proc")
def _(t: Tables):
    path = sinks.scratch_path(t.catalog, "report")
    report = stats.catalog_summary(t.processed).drop("avg_magnitude")
    sinks.write_report(report, path)
    return t.spark.read.schema(report.schema).json(path)


@query("s18_collection_windows", f"""WITH {EV}, w AS (SELECT i AS k, DATE '2023-11-01' + (i*10)::INTEGER AS a FROM range(200) g(i)), x AS (SELECT a, least(a+9, DATE '2024-03-01') AS b FROM w WHERE a < DATE '2024-03-01')
 SELECT a::VARCHAR AS starttime, b::VARCHAR AS endtime, count(*) AS events FROM ev JOIN x ON CAST(time AS DATE) BETWEEN a AND b GROUP BY 1,2""")
def _(t: Tables):
    tagged = windows.with_window(t.catalog, "2023-11-01", "2024-03-01", days=9).filter("starttime is not null")
    return tagged.groupBy(c("starttime").cast("string").alias("starttime"), c("endtime").cast("string").alias("endtime")).agg(
        F.count(F.lit(1)).alias("events"))


@query("s18_window_coverage", f"""WITH {EV}, x AS (SELECT a, least(a+90, DATE '2024-12-31') AS b FROM (SELECT DATE '2023-01-01' + (i*91)::INTEGER AS a FROM range(20) g(i)) WHERE a < DATE '2024-12-31')
 SELECT a::VARCHAR AS starttime, b::VARCHAR AS endtime, count(id) AS events FROM x LEFT JOIN ev ON CAST(time AS DATE) BETWEEN a AND b GROUP BY 1,2""")
def _(t: Tables):
    spans = windows.collection_windows(t.spark, "2023-01-01", "2024-12-31")
    counted = windows.with_window(t.catalog, "2023-01-01", "2024-12-31").filter("starttime is not null").groupBy("starttime").agg(F.count(F.lit(1)).alias("events"))
    return spans.join(F.broadcast(counted), "starttime", "left").select(
        c("starttime").cast("string").alias("starttime"), c("endtime").cast("string").alias("endtime"), F.coalesce("events", F.lit(0)).alias("events"))


@query("s4_read_line_breaks", f"WITH {EV} SELECT id, magnitude, place || chr(10) || 'second, \"line\"' AS place FROM ev")
def _(t: Tables):
    """Quoted commas, quotes and line breaks inside a field."""
    path = sinks.scratch_path(t.catalog, "breaks") + ".csv"
    text = F.concat("place", F.lit('\nsecond, "line"'))
    t.catalog.select("magnitude", text.alias("place"), "id").write.option("header", True).option("escape", '"').csv(path)
    return files.read_csv_by_name(t.spark, path, line_breaks=True).select("id", c("magnitude").cast("double").alias("magnitude"), "place")


@query("s13_store_run", f"""WITH RECURSIVE {CLUSTERS} SELECT 'earthquakes_processed' AS table_name, count(*) AS "rows" FROM proc UNION ALL SELECT 'earthquake_clusters', count(*) FROM clus
 UNION ALL SELECT 'earthquake_risk_classifications', count(*) FROM cls UNION ALL SELECT 'hazard_zones', count(*) FROM zones""")
def _(t: Tables):
    """The four tables of a run, stored as one version; counted while written and in the files."""
    return store(t.stored, sinks.scratch_path(t.catalog, "run"))


@query("s14_append_twice", f"WITH {ENH} SELECT strftime(datetime_local, '%Y-%m') AS month_batch, CASE WHEN magnitude >= 5 THEN 'strong' ELSE 'rest' END AS batch, count(*) AS events FROM enh GROUP BY 1,2")
def _(t: Tables):
    """Two batches, both appended twice."""
    path = sinks.scratch_path(t.catalog, "batches")
    strong = F.coalesce(c("magnitude") >= 5, F.lit(False))
    rows = t.enhanced.select(*ENHANCED_COLUMNS)
    for name, part in (("strong", strong), ("rest", ~strong), ("strong", strong), ("rest", ~strong)):
        sinks.append_by_month(rows.filter(part), path, batch=name)
    return sinks.read_months(t.spark, path).groupBy("month_batch", "batch").agg(F.count(F.lit(1)).alias("events"))


@query("s14_change_months", f"""WITH {ENH}, m AS (SELECT *, strftime(datetime_local, '%Y-%m') AS month_batch FROM enh)
 SELECT id, round(depth, 1) AS depth, magnitude, true AS kept_files FROM m WHERE NOT (month_batch = '2022-03' AND magnitude < 5) AND month_batch <> '2022-05'""")
def _(t: Tables):
    """Rows deleted and changed in two months; the files of all other months stay."""
    path = sinks.scratch_path(t.catalog, "changed")
    sinks.append_by_month(t.enhanced.select(*ENHANCED_COLUMNS), path, batch="all")

    def files_outside() -> set[str]:
        names = sinks.read_months(t.spark, path).select(F.input_file_name().alias("f")).distinct().collect()
        return {r["f"] for r in names if "2022-03" not in r["f"] and "2022-05" not in r["f"]}

    before = files_outside()
    gone = ((c("month_batch") == "2022-03") & (c("magnitude") < 5)) | (c("month_batch") == "2022-05")
    sinks.change_months(t.spark, path, gone, lambda rows: maintain.delete(rows, gone)[0])
    same = before == files_outside()
    return sinks.read_months(t.spark, path).select("id", F.round("depth", 1).alias("depth"), "magnitude", F.lit(same).alias("kept_files"))
