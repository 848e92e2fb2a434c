"""Aggregations, shares, chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.base import Tables, query, rounded, stamp
from suite.sql import CLUSTERS, ENH, EV, EVAL, FEAT, LABELS, PROC, r, stamp as sql_stamp
from tremor.learning.prepare import exact_medians, z_scores
from tremor.operators import charts, hazard, stats
from tremor.plans import evaluation
from tremor.workspace import constants

c = F.col


@query("a1_zone_stats", f"""WITH {FEAT} SELECT geographic_zone, count(*) AS earthquake_count, {r('avg(magnitude)')} AS avg_magnitude, {r('stddev_samp(magnitude)')} AS std_magnitude,
 max(magnitude) AS max_magnitude, min(magnitude) AS min_magnitude, {r('avg(depth)')} AS avg_depth, {r('avg(risk_score)')} AS avg_risk_score FROM feat GROUP BY 1""")
def _(t: Tables):
    return rounded(stats.zone_stats(t.features), "avg_magnitude", "std_magnitude", "avg_depth", "avg_risk_score")


@query("a2_monthly_stats", f"""WITH {FEAT} SELECT year, month, count(*) AS monthly_count, {r('avg(magnitude)')} AS monthly_avg_magnitude,
 max(magnitude) AS monthly_max_magnitude, {r('avg(risk_score)')} AS monthly_avg_risk FROM feat GROUP BY 1,2""")
def _(t: Tables):
    return rounded(stats.monthly_stats(t.features), "monthly_avg_magnitude", "monthly_avg_risk")


@query("a3_category_distribution", f"WITH {FEAT} SELECT magnitude_category, count(*) AS category_count, {r('avg(depth)')} AS avg_depth_by_magnitude FROM feat GROUP BY 1")
def _(t: Tables):
    return rounded(stats.category_distribution(t.features), "avg_depth_by_magnitude")


@query("a8_risk_zone_summary", f"""WITH RECURSIVE {CLUSTERS} SELECT risk_zone, count(DISTINCT cluster_id) AS cluster_count, count(*) AS total_events,
 {r('avg(avg_magnitude)')} AS avg_magnitude, {r('max(avg_magnitude)')} AS max_magnitude FROM clus GROUP BY 1""")
def _(t: Tables):
    return rounded(hazard.risk_zone_summary(t.clusters), "avg_magnitude", "max_magnitude")


@query("a8_clustering_report", f"""WITH RECURSIVE {CLUSTERS}, z AS (SELECT risk_zone, count(*) AS n, avg(avg_magnitude) AS a, max(avg_magnitude) AS m FROM clus GROUP BY 1)
 SELECT (SELECT count(DISTINCT cluster_id) FROM clus) AS total_clusters, count(*) FILTER (WHERE risk_zone IN ('High','Extreme')) AS high_risk_zones,
 CAST(sum(n) AS BIGINT) AS total_clustered_events, count(*) AS risk_zone_diversity, max(n) AS largest_zone_events, {r('max(m)')} AS max_magnitude, {r('avg(a)')} AS mean_of_zone_means FROM z""")
def _(t: Tables):
    return rounded(hazard.clustering_report(t.clusters).drop("risk_zones"), "max_magnitude", "mean_of_zone_means")


@query("a9_platform_stats", f"""WITH RECURSIVE {CLUSTERS}, d AS (SELECT risk_zone, count(DISTINCT id) AS n FROM clus GROUP BY 1)
 SELECT (SELECT count(*) FROM proc) AS total_earthquakes, (SELECT count(DISTINCT cluster_id) FROM clus) AS total_clusters,
 (SELECT count(DISTINCT cluster_id) FROM clus WHERE risk_zone IN ('High','Extreme')) AS high_risk_zones, risk_zone, n AS "count" FROM d""")
def _(t: Tables):
    row = stats.platform_stats(t.processed, t.clusters)
    return row.select("total_earthquakes", "total_clusters", "high_risk_zones", F.inline("risk_distribution"))


@query("a10_pipeline_status", f"""WITH RECURSIVE {CLUSTERS}, k AS (SELECT (SELECT count(*) FROM proc) AS n, (SELECT count(DISTINCT cluster_id) FROM clus) AS cl, (SELECT count(*) FROM cls) AS cn, (SELECT CASE WHEN count(DISTINCT risk_zone) >= 2 THEN 2 ELSE 0 END FROM clus) AS mt)
 SELECT n AS earthquake_records, cl AS clusters_identified, mt::BIGINT AS models_trained, cn AS classifications_generated,
 CASE WHEN n=0 THEN 'error' WHEN n<1000 THEN 'warning' ELSE 'healthy' END AS pipeline_status, round(n*2/1024,2) AS estimated_size_mb,
 n*2/1024>=64 AS meets_volume_target, cl>0 AS clustering_completed, mt>0 AS ml_ready,
 concat_ws('; ', CASE WHEN n<1000 THEN 'collect more records' END, CASE WHEN cl=0 THEN 'run the clustering' END, CASE WHEN mt=0 THEN 'train the models' END, CASE WHEN n*2/1024<64 THEN 'collect more volume' END) AS recommendations FROM k""")
def _(t: Tables):
    status = stats.pipeline_status(t.processed, t.clusters, t.models, t.classifications)
    return status.withColumn("recommendations", F.concat_ws("; ", "recommendations"))


@query("a11_data_volume", f"""WITH {PROC} SELECT count(*) AS total_records, count(DISTINCT id) AS unique_earthquakes, {sql_stamp('min(time)')} AS earliest_record, {sql_stamp('max(time)')} AS latest_record,
 round(avg(magnitude),2) AS avg_magnitude, count(DISTINCT region) AS regions_covered, round(count(*)*2/1024,2) AS estimated_size_mb,
 CASE WHEN count(*)*2/1024>=64 THEN 'compliant' ELSE 'non_compliant' END AS requirement_status FROM proc""")
def _(t: Tables):
    return stats.data_volume(t.processed).withColumns({x: stamp(x) for x in ("earliest_record", "latest_record")})


@query("a12_catalog_summary", f"WITH {PROC} SELECT count(*) AS total_earthquakes, {r('avg(magnitude)')} AS avg_magnitude, max(magnitude) AS max_magnitude, count(DISTINCT region) AS unique_regions FROM proc")
def _(t: Tables):
    return rounded(stats.catalog_summary(t.processed), "avg_magnitude")


@query("a13_zone_cluster_summary", f"WITH RECURSIVE {CLUSTERS} SELECT risk_zone, count(*) AS row_count, {r('avg(avg_magnitude)')} AS avg_magnitude, CAST(sum(cluster_size) AS BIGINT) AS summed_cluster_size FROM clus GROUP BY 1")
def _(t: Tables):
    return rounded(stats.zone_cluster_summary(t.clusters), "avg_magnitude")


@query("a13_zone_cluster_summary_once", f"""WITH RECURSIVE {CLUSTERS} SELECT risk_zone, count(*) AS row_count, {r('avg(avg_magnitude)')} AS avg_magnitude, CAST(sum(cluster_size) AS BIGINT) AS summed_cluster_size
 FROM (SELECT DISTINCT risk_zone, cluster_id, cluster_size, avg_magnitude FROM clus) GROUP BY 1""")
def _(t: Tables):
    return rounded(stats.zone_cluster_summary(t.clusters, per_cluster=True), "avg_magnitude")


@query("a14_master_report", f"""WITH RECURSIVE {CLUSTERS} SELECT (SELECT count(*) FROM proc) AS total_earthquakes, (SELECT count(DISTINCT cluster_id) FROM clus) AS total_clusters,
 (SELECT count(*) FROM zones) AS high_risk_zones, (SELECT CASE WHEN count(DISTINCT risk_zone) >= 2 THEN 2 ELSE 0 END FROM clus)::BIGINT AS models_trained, risk_zone, count(*) AS events FROM clus GROUP BY risk_zone""")
def _(t: Tables):
    report = stats.master_report(t.processed, t.clusters, t.zones, t.models)
    return report.select(
        "total_earthquakes", "total_clusters", "high_risk_zones", "models_trained",
        F.explode("risk_distribution").alias("risk_zone", "events"))


@query("a15_events_by_zone", f"WITH {EVAL} SELECT geographic_zone, count(*) AS earthquake_count, round(avg(magnitude),2) AS avg_magnitude, round(max(magnitude),2) AS max_magnitude, round(avg(risk_score),3) AS avg_risk_score FROM eva GROUP BY 1")
def _(t: Tables):
    return evaluation.by_zone(t.evaluated)


@query("a16_monthly_trends", f"WITH {EVAL} SELECT year, month, count(*) AS monthly_count, round(avg(magnitude),2) AS avg_magnitude, count(*) FILTER (WHERE magnitude>=5) AS major_earthquakes FROM eva GROUP BY 1,2")
def _(t: Tables):
    return evaluation.monthly_trends(t.evaluated)


@query("a17_depth_analysis", f"WITH {EVAL} SELECT depth_category_detailed, count(*) AS \"count\", round(avg(magnitude),2) AS avg_magnitude, round(avg(depth),1) AS avg_depth, round(avg(risk_score),3) AS avg_risk_score FROM eva GROUP BY 1")
def _(t: Tables):
    return evaluation.depth_analysis(t.evaluated)


@query("a18_high_risk", f"""WITH {EVAL} SELECT geographic_zone, magnitude_category, count(*) AS "count", round(avg(risk_score),3) AS avg_risk_score, {r('avg(population_impact_estimate)', 0)} AS avg_population_impact
 FROM eva WHERE risk_score>0.7::DOUBLE GROUP BY 1,2""")
def _(t: Tables):
    return evaluation.high_risk(t.evaluated)


@query("a19_cell_analysis", f"""WITH {EVAL} SELECT coalesce(earthquake_cluster,-1) AS earthquake_cluster, geographic_zone, count(*) AS cluster_size, {r('avg(magnitude)', 9)} AS avg_magnitude,
 {r('avg(depth)', 9)} AS avg_depth, {r('avg(risk_score)', 9)} AS avg_risk, {r('count(*)*100.0::DOUBLE/(SELECT count(*) FROM eva)')} AS percentage FROM eva GROUP BY 1,2""")
def _(t: Tables):
    cells = rounded(evaluation.cell_analysis(t.evaluated, (12, 12, 12)), "avg_magnitude", "avg_depth", "avg_risk", digits=9)
    return rounded(cells, "percentage")


@query("w2_percent_of_total", f"""WITH {EVAL} SELECT earthquake_cluster, geographic_zone, count(*) AS cluster_size, {r('count(*)*100.0::DOUBLE/sum(count(*)) OVER ()')} AS percentage FROM eva GROUP BY 1,2""")
def _(t: Tables):
    return rounded(evaluation.cell_analysis(t.evaluated), "percentage").select("earthquake_cluster", "geographic_zone", "cluster_size", "percentage")


@query("a20_recent_depth_stats", f"""WITH {ENH} SELECT depth_category, count(*) AS event_count, {r('avg(magnitude)')} AS avg_magnitude, {r('max(magnitude)')} AS max_magnitude,
 {r('min(depth)')} AS min_depth, {r('max(depth)')} AS max_depth, {r('avg(hazard_score)')} AS avg_hazard_score FROM enh
 WHERE datetime_local >= (SELECT max(datetime_local) FROM enh) - INTERVAL 30 DAY GROUP BY 1""")
def _(t: Tables):
    from tremor.plans.served import recent_depth_stats

    as_of = t.enhanced.agg(F.max("datetime_local").alias("m")).scalar()
    return recent_depth_stats(t.enhanced, as_of, digits=6)


@query("a21_daily_stats", f"""WITH {EV} SELECT CAST(CAST(time AS DATE) AS VARCHAR) AS date, count(magnitude) AS earthquake_count, {r('avg(magnitude)')} AS avg_magnitude, max(magnitude) AS max_magnitude, {r('avg(depth)')} AS avg_depth FROM ev GROUP BY 1""")
def _(t: Tables):
    return rounded(stats.daily_stats(t.catalog), "avg_magnitude", "avg_depth").withColumn("date", c("date").cast("string"))


@query("a21_average_daily", f"WITH {EV} SELECT {r('avg(n)')} AS avg_daily FROM (SELECT CAST(time AS DATE) AS d, count(*) AS n FROM ev GROUP BY 1)")
def _(t: Tables):
    return rounded(stats.average_daily_count(t.catalog), "avg_daily")


MONTHS = "'January','February','March','April','May','June','July','August','September','October','November','December'"
DAYS = "'Monday','Tuesday','Wednesday','Thursday','Friday','Saturday','Sunday'"
SPINES = {
    "month": ("(SELECT (i-1)::INTEGER AS position, i::VARCHAR AS bucket FROM range(1,13) g(i))", "month(time)::VARCHAR"),
    "hour": ("(SELECT i::INTEGER AS position, i::VARCHAR AS bucket FROM range(24) g(i))", "hour(time)::VARCHAR"),
    "weekday": (f"(SELECT (i-1)::INTEGER AS position, [{DAYS}][i] AS bucket FROM range(1,8) g(i))", "dayname(time)"),
    "month_name": (f"(SELECT (i-1)::INTEGER AS position, [{MONTHS}][i] AS bucket FROM range(1,13) g(i))", "monthname(time)"),
}


def _calendar(unit: str, spine: str, bucket: str) -> None:
    @query(f"a22_by_{unit}", f"""WITH {EV}, n AS (SELECT {bucket} AS bucket, count(*) AS events FROM ev GROUP BY 1)
     SELECT position, bucket, coalesce(events,0) AS events FROM {spine} s LEFT JOIN n USING (bucket)""")
    def run(t: Tables):
        return charts.calendar_counts(t.catalog, unit)


for _unit, (_spine, _bucket) in SPINES.items():
    _calendar(_unit, _spine, _bucket)


@query("a22_by_year", f"WITH {EV} SELECT year(time)::INTEGER AS position, year(time)::VARCHAR AS bucket, count(*) AS events FROM ev GROUP BY 1,2")
def _(t: Tables):
    return charts.calendar_counts(t.catalog, "year")


@query("a23_peak_hour", f"WITH {EV} SELECT hour(time)::VARCHAR AS bucket, count(*) AS events FROM ev GROUP BY hour(time) ORDER BY events DESC, hour(time) LIMIT 1")
def _(t: Tables):
    return charts.peak_bucket(charts.calendar_counts(t.catalog, "hour"))


def _shares(name: str, column: str, source: str, table: str, cte: str) -> None:
    @query(name, f"WITH RECURSIVE {cte} SELECT {column}, count(*) AS \"count\", {r(f'count(*)*100.0::DOUBLE/(SELECT count(*) FROM {table})')} AS percentage FROM {table} GROUP BY 1")
    def run(t: Tables):
        return rounded(stats.value_shares(getattr(t, source), column), "percentage")


_shares("a24_alert_shares", "alert", "catalog", "ev", EV)
_shares("a24_tsunami_shares", "tsunami", "catalog", "ev", EV)
_shares("a24_region_shares", "region", "processed", "proc", PROC)
_shares("a24_category_shares", "magnitude_category", "processed", "proc", PROC)
_shares("a24_risk_zone_shares", "risk_zone", "clusters", "clus", CLUSTERS)


def _histogram(name: str, column: str, bins: int, source: str, table: str, cte: str) -> None:
    @query(name, f"""WITH {cte}, e AS (SELECT min({column}) AS lo, (max({column})-min({column}))/{bins} AS w FROM {table}),
     n AS (SELECT least(floor(({column}-lo)/w)::BIGINT, {bins - 1})::INTEGER AS bin, count(*) AS events FROM {table}, e WHERE {column} IS NOT NULL GROUP BY 1)
     SELECT i::INTEGER AS bin, {r('lo+i*w')} AS low, {r('lo+(i+1)*w')} AS high, coalesce(events,0) AS events FROM range({bins}) g(i) CROSS JOIN e LEFT JOIN n ON n.bin = i""")
    def run(t: Tables):
        return rounded(charts.histogram(getattr(t, source), column, bins), "low", "high")


_histogram("a25_magnitude_histogram", "magnitude", 30, "catalog", "ev", EV)
_histogram("a25_depth_histogram", "depth", 30, "catalog", "ev", EV)
_histogram("a25_risk_histogram", "risk_score", 25, "evaluated", "eva", EVAL)
_histogram("a25_hazard_histogram", "hazard_score", 25, "enhanced", "enh", ENH)


def _boxes(name: str, group: str, value: str) -> None:
    parts = ", ".join(f"{r(f'quantile_cont({value},{p})', 9)} AS {n}" for n, p in (("low", 0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("high", 1)))

    @query(name, f"WITH {PROC} SELECT {group}, {parts} FROM proc GROUP BY 1")
    def run(t: Tables):
        return rounded(charts.five_numbers(t.processed, group, value), "low", "q1", "median", "q3", "high", digits=9)


_boxes("a26_depth_by_region", "region", "depth")
_boxes("a26_magnitude_by_depth", "depth_category", "magnitude")

NUMERIC = ["magnitude", "depth", "hazard_score", "latitude", "longitude", "spatial_density"]


@query("a27_correlations", f"WITH {PROC} " + " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, {r(f'corr({a},{b})') if a != b else 'max(1.0::DOUBLE)'} AS r FROM proc" for a in NUMERIC for b in NUMERIC))
def _(t: Tables):
    return rounded(stats.correlations(t.processed, NUMERIC), "r")


@query("a28_linear_trend", f"WITH {ENH} SELECT {r('regr_slope(hazard_score, magnitude)')} AS slope, {r('regr_intercept(hazard_score, magnitude)')} AS intercept FROM enh")
def _(t: Tables):
    return rounded(stats.linear_trend(t.enhanced, "magnitude", "hazard_score"), "slope", "intercept")


MEDIANS = ["magnitude", "depth", "felt", "cdi", "mmi", "sig", "nst", "dmin", "rms", "gap"]


@query("a29_approximate_medians", f"WITH {EV} " + " UNION ALL ".join(
    f"SELECT '{m}' AS \"column\", count({m}) AS present, true AS within_tolerance FROM ev" for m in MEDIANS))
def _(t: Tables):
    """The approximate median may be any value whose rank is within the tolerance, so the rank is checked."""
    values = constants(stats.approximate_medians(t.catalog, MEDIANS, 100))
    ranks = t.catalog.agg(*[
        F.struct(
            F.lit(m).alias("column"), F.count(m).alias("present"),
            ((F.count_if(c(m) <= values[m]) >= 0.49 * F.count(m)) & (F.count_if(c(m) < values[m]) <= 0.51 * F.count(m))).alias("within_tolerance"),
        ).alias(m) for m in MEDIANS])
    return ranks.select(F.explode(F.array(*MEDIANS)).alias("x")).select("x.*")


@query("a30_exact_medians", f"WITH {EV} SELECT " + ", ".join(f"{r(f'median({m})', 9)} AS {m}" for m in MEDIANS) + " FROM ev")
def _(t: Tables):
    return rounded(exact_medians(t.catalog, MEDIANS), *MEDIANS, digits=9)


CLUSTERING = ["longitude", "latitude", "depth", "magnitude", "hazard_score", "intensity_score"]


@query("a31_population_moments", f"WITH {ENH} SELECT " + ", ".join(f"{r(f'avg({x})')} AS {x}_mean, {r(f'stddev_pop({x})')} AS {x}_std" for x in CLUSTERING) + " FROM enh")
def _(t: Tables):
    moments = stats.population_moments(t.enhanced, CLUSTERING)
    return rounded(moments, *moments.columns)


@query("a32_distinct_values", f"WITH {PROC} SELECT count(DISTINCT region) AS regions, count(DISTINCT magnitude_category) AS categories, count(DISTINCT alert) AS alerts FROM proc")
def _(t: Tables):
    return t.processed.agg(*[F.countDistinct(x).alias(n) for x, n in (("region", "regions"), ("magnitude_category", "categories"), ("alert", "alerts"))])


@query("a32_class_distribution", f"WITH RECURSIVE {CLUSTERS} SELECT risk_zone, count(*) AS \"count\" FROM clus GROUP BY 1")
def _(t: Tables):
    return t.clusters.groupBy("risk_zone").count()


@query("a33_describe", f"WITH {ENH} " + " UNION ALL ".join(
    f"SELECT '{x}' AS \"column\", count({x}) AS \"count\", {r(f'avg({x})')} AS mean, {r(f'stddev_samp({x})')} AS std, min({x})::DOUBLE AS \"min\", max({x})::DOUBLE AS \"max\" FROM enh" for x in CLUSTERING))
def _(t: Tables):
    return rounded(stats.describe(t.enhanced, CLUSTERING), "mean", "std")


@query("a34_cluster_profiles", f"""WITH RECURSIVE {LABELS}, e AS (SELECT proc.*, cluster_id FROM proc JOIN labels USING (id)),
 m AS (SELECT cluster_id, region AS dominant_region FROM e GROUP BY 1,2 QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC, region)=1)
 SELECT cluster_id, CASE WHEN cluster_id=-1 THEN 'Noise/Outliers' ELSE 'Hazard Zone ' || (cluster_id+1) END AS cluster_name, count(*) AS "count", {r('avg(magnitude)')} AS avg_magnitude,
 max(magnitude) AS max_magnitude, {r('avg(depth)')} AS avg_depth, {r('avg(hazard_score)')} AS avg_hazard_score, count(*) FILTER (WHERE tsunami=1) AS tsunami_events,
 count(*) FILTER (WHERE alert IN ('orange','red')) AS high_alert_events, any_value(dominant_region) AS dominant_region, {r('avg(latitude)')} AS latitude_center, {r('avg(longitude)')} AS longitude_center
 FROM e JOIN m USING (cluster_id) GROUP BY cluster_id""")
def _(t: Tables):
    joined = t.processed.join(t.labels.select("id", "cluster_id"), "id")
    return rounded(hazard.cluster_profiles(joined), "avg_magnitude", "avg_depth", "avg_hazard_score", "latitude_center", "longitude_center")


@query("a35_view_indicators", f"""WITH {PROC} SELECT count(*) AS records, {r('avg(latitude)')} AS center_lat, {r('avg(longitude)')} AS center_lon, {r('avg(magnitude)')} AS avg_magnitude,
 {r('avg(hazard_score)')} AS avg_hazard, count(DISTINCT region) AS regions FROM proc""")
def _(t: Tables):
    return rounded(stats.view_indicators(t.processed), "center_lat", "center_lon", "avg_magnitude", "avg_hazard")


@query("a36_size_estimate", f"WITH {EV} SELECT CAST(sum(length(id || ',' || place_text || ',' || felt) + 1) AS BIGINT) AS csv_bytes FROM (SELECT id, '\"' || place || '\"' AS place_text, felt FROM ev)")
def _(t: Tables):
    return stats.size_estimate(t.catalog.select("id", "place", "felt"))


@query("l6_z_scores", f"""WITH {ENH} SELECT id, {', '.join(r(f'(coalesce({x},0)-(avg(coalesce({x},0)) OVER ()))/(stddev_pop(coalesce({x},0)) OVER ())') + f' AS {n}' for x, n in
 zip(CLUSTERING, ('lon_norm','lat_norm','depth_norm','mag_norm','hazard_norm','intensity_norm')))} FROM enh""")
def _(t: Tables):
    names = ["lon_norm", "lat_norm", "depth_norm", "mag_norm", "hazard_norm", "intensity_norm"]
    return rounded(z_scores(t.enhanced), *names).select("id", *names)
