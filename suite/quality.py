"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.base import Tables, query, rounded
from suite.sql import CLUSTERS, EV, EVAL, PROC, REGION, r
from tremor.functions.classify import region
from tremor.operators import validate
from tremor.plans import evaluation
from tremor.sources import sinks

c = F.col


def _rule(i, kind, column, failed, passed) -> str:
    return f"SELECT {i} AS rule, '{kind}' AS kind, '{column}' AS \"column\", {failed} AS failed, count(*) AS total, {passed} AS passed FROM "


def _results(rules, table: str) -> str:
    parts = []
    for i, rule in enumerate(rules):
        kind, column = rule[0], rule[1]
        if kind == "row_count":
            ok = f"count(*) BETWEEN {rule[2]} AND {rule[3]}"
            parts.append(_rule(i, kind, "*", f"CASE WHEN {ok} THEN 0::BIGINT ELSE 1::BIGINT END", ok) + table)
            continue
        if kind == "not_null":
            bad, mostly = f"{column} IS NULL", rule[2] if len(rule) > 2 else 1.0
        elif kind == "between":
            bad, mostly = f"{column} NOT BETWEEN {rule[2]} AND {rule[3]}", 1.0
        else:
            bad, mostly = f"{column} NOT IN ({', '.join(repr(v) for v in rule[2])})", 1.0
        n = f"count(*) FILTER (WHERE {bad})"
        parts.append(_rule(i, kind, column, n, f"{n} <= count(*)*{1 - mostly}") + table)
    return " UNION ALL ".join(parts)


RAW = [("row_count", "*", 1000, 100_000), ("not_null", "id"), ("not_null", "magnitude"), ("between", "magnitude", 0, 10),
       ("between", "latitude", -12, 8), ("between", "longitude", 94, 142), ("between", "depth", 0, 800)]
PROCESSED = [
    ("row_count", "*", 1000, 200_000), ("not_null", "id"), ("not_null", "magnitude"), ("not_null", "latitude"), ("not_null", "longitude"),
    ("between", "magnitude", 0.5, 10), ("between", "latitude", -12, 8), ("between", "longitude", 94, 142), ("between", "depth", 0, 800),
    ("between", "hazard_score", 0, 10), ("between", "spatial_density", 0, 100),
    ("in_set", "region", ["Java", "Sumatra", "Sulawesi", "Eastern_Indonesia", "Kalimantan", "Other"]),
    ("in_set", "magnitude_category", ["Very Minor", "Minor", "Light", "Moderate", "Strong", "Major"]),
    ("in_set", "depth_category", ["Very Shallow", "Shallow", "Intermediate", "Deep"]), ("not_null", "time", 0.95),
]


@query("v1_row_count", f"WITH {EV} " + _results(RAW[:1], "ev"))
def _(t: Tables):
    return validate.check(t.catalog, validate.raw_rules(max_rows=100_000)[:1])


@query("v2_not_null", f"WITH {EV} " + _results([("not_null", "alert", 0.5), ("not_null", "id"), ("not_null", "alert")], "ev"))
def _(t: Tables):
    return validate.check(t.catalog, [validate.not_null("alert", 0.5), validate.not_null("id"), validate.not_null("alert")])


@query("v3_between", f"WITH {EV} " + _results(RAW, "ev"))
def _(t: Tables):
    return validate.check(t.catalog, validate.raw_rules(max_rows=100_000))


@query("v4_in_set", f"WITH {EV} " + _results([("in_set", "alert", ["red", "orange"]), ("in_set", "net", ["us"])], "ev"))
def _(t: Tables):
    return validate.check(t.catalog, [validate.in_set("alert", ["red", "orange"]), validate.in_set("net", ["us"])])


@query("v5_processed_rules", f"WITH {PROC} " + _results(PROCESSED, "proc"))
def _(t: Tables):
    return validate.check(t.processed, validate.processed_rules(max_rows=200_000))


@query("v5_report", f"""WITH {PROC}, results AS ({_results(PROCESSED, 'proc')}) SELECT count(*) AS total_expectations, count(*) FILTER (WHERE passed) AS successful_expectations,
 count(*) FILTER (WHERE NOT passed) AS failed_expectations, bool_and(passed) AS success, {r('avg(CASE WHEN passed THEN 1 ELSE 0 END)')} AS data_quality_score FROM results""")
def _(t: Tables):
    return rounded(validate.report(validate.check(t.processed, validate.processed_rules(max_rows=200_000))), "data_quality_score")


FIELDS = {
    "magnitude": "magnitude IS NULL", "latitude": "latitude IS NULL OR latitude NOT BETWEEN -90 AND 90",
    "longitude": "longitude IS NULL OR longitude NOT BETWEEN -180 AND 180", "depth": "depth IS NULL OR depth<0",
}


@query("v6_field_quality", f"WITH {EVAL} " + " UNION ALL ".join(
    f"SELECT '{f}' AS field, count(*) FILTER (WHERE {x}) AS null_count, {r(f'count(*) FILTER (WHERE {x})*100.0::DOUBLE/count(*)')} AS null_percentage, CASE WHEN count(*) FILTER (WHERE {x})*100.0/count(*)<5 THEN 'PASS' ELSE 'FAIL' END AS status FROM eva"
    for f, x in FIELDS.items()))
def _(t: Tables):
    return rounded(validate.field_quality(t.evaluated), "null_percentage")


IN_RANGE = "count(*) FILTER (WHERE magnitude BETWEEN 2.5 AND 9.5)*100.0::DOUBLE/count(*)"


@query("v7_magnitude_range", f"WITH {EVAL} SELECT min(magnitude) AS min_magnitude, max(magnitude) AS max_magnitude, {r('avg(magnitude)')} AS avg_magnitude, {r(IN_RANGE)} AS valid_range_percentage, CASE WHEN {IN_RANGE}>95 THEN 'PASS' ELSE 'FAIL' END AS status FROM eva")
def _(t: Tables):
    return rounded(validate.magnitude_range(t.evaluated), "avg_magnitude", "valid_range_percentage")


@query("v8_zone_distribution", f"WITH {EVAL} SELECT geographic_zone, count(*) AS zone_count, {r('avg(magnitude)')} AS avg_magnitude, 'PASS' AS status FROM eva GROUP BY 1")
def _(t: Tables):
    return rounded(validate.zone_distribution(t.evaluated), "avg_magnitude")


@query("v9_temporal_coverage", f"""WITH {EVAL} SELECT min(year) AS min_year, max(year) AS max_year, max(year)-min(year) AS year_span, count(DISTINCT year) AS unique_years,
 count(DISTINCT month) AS unique_months, CASE WHEN count(DISTINCT year)>1 THEN 'PASS' ELSE 'FAIL' END AS status FROM eva""")
def _(t: Tables):
    return validate.temporal_coverage(t.evaluated)


@query("v10_overall_status", f"""WITH {EVAL}, s AS (SELECT 'record_count' AS test, CASE WHEN count(*)>0 THEN 'PASS' ELSE 'FAIL' END AS status FROM eva UNION ALL """ + " UNION ALL ".join(
    f"SELECT '{f}_quality', CASE WHEN count(*) FILTER (WHERE {x})*100.0/count(*)<5 THEN 'PASS' ELSE 'FAIL' END FROM eva" for f, x in FIELDS.items()) + f"""
 UNION ALL SELECT 'magnitude_range', CASE WHEN {IN_RANGE}>95 THEN 'PASS' ELSE 'FAIL' END FROM eva UNION ALL SELECT 'geographic_distribution', 'PASS'
 UNION ALL SELECT 'temporal_coverage', CASE WHEN count(DISTINCT year)>1 THEN 'PASS' ELSE 'FAIL' END FROM eva)
 SELECT * FROM s UNION ALL SELECT 'overall', CASE WHEN bool_and(status='PASS') THEN 'PASS' ELSE 'FAIL' END FROM s""")
def _(t: Tables):
    return validate.overall_status(t.evaluated)


@query("v10_key_violations", f"WITH {EV} SELECT felt, cdi, count(*) AS \"rows\" FROM ev GROUP BY 1,2 HAVING count(*)>1")
def _(t: Tables):
    return validate.key_violations(t.catalog, ["felt", "cdi"])


@query("v11_reference_violations", f"WITH RECURSIVE {CLUSTERS} SELECT count(*) FILTER (WHERE id NOT IN (SELECT id FROM proc WHERE depth_category='Shallow')) AS violations, count(*) AS checked FROM clus")
def _(t: Tables):
    from tremor.workspace import materialise

    parents = materialise(t.processed.filter("depth_category = 'Shallow'").select("id"), "parents")
    return validate.reference_violations(t.clusters, parents, "id")


@query("v12_landed_file", f"""WITH {EV} SELECT count(*) AS records, min(year(time))::INTEGER AS first_year, max(year(time))::INTEGER AS last_year, count(DISTINCT region) AS regions,
 count(*)>100 AS enough_records, 'below target' AS size_status FROM (SELECT *, {REGION} AS region FROM ev)""")
def _(t: Tables):
    landed = t.catalog.withColumns({"year": F.year("time"), "region": region(c("longitude"), c("latitude"))})
    path = sinks.scratch_path(t.catalog, "landed")
    sinks.write_parquet(landed, path)
    size_mb = sinks.folder_bytes(landed, path) / 1e6
    return validate.landed_file_check(t.spark.read.schema(landed.schema).parquet(path), size_mb)


@query("v13_suite_summary", f"""WITH {EVAL}, n AS (SELECT (SELECT least(count(*),10) FROM eva) AS a, (SELECT count(DISTINCT geographic_zone) FROM eva) AS b, (SELECT count(*) FROM (SELECT DISTINCT year, month FROM eva)) AS c,
 (SELECT count(DISTINCT depth_category_detailed) FROM eva) AS d, (SELECT count(*) FROM (SELECT DISTINCT geographic_zone, magnitude_category FROM eva WHERE risk_score>0.7::DOUBLE)) AS e, (SELECT count(*) FROM (SELECT DISTINCT earthquake_cluster, geographic_zone FROM eva)) AS f)
 SELECT 'top_magnitude_earthquakes' AS query, 'SUCCESS' AS status, a AS row_count FROM n UNION ALL SELECT 'earthquakes_by_zone','SUCCESS',b FROM n UNION ALL SELECT 'monthly_trends','SUCCESS',c FROM n
 UNION ALL SELECT 'depth_analysis','SUCCESS',d FROM n UNION ALL SELECT 'high_risk_analysis','SUCCESS',e FROM n UNION ALL SELECT 'clustering_analysis','SUCCESS',f FROM n""")
def _(t: Tables):
    return evaluation.summary(t.evaluated).drop("error")


@query("v8_no_zone", "SELECT CAST(NULL AS VARCHAR) AS geographic_zone, 0::BIGINT AS zone_count, CAST(NULL AS DOUBLE) AS avg_magnitude, 'FAIL' AS status FROM (SELECT count(*) AS n FROM events WHERE event_id < 0) WHERE n = 0")
def _(t: Tables):
    return validate.zone_distribution(t.evaluated.withColumn("geographic_zone", F.when(c("magnitude") < 0, c("geographic_zone"))))


@query("v13_failed_query", f"WITH {EV} SELECT 'sound' AS query, 'SUCCESS' AS status, count(*) AS row_count FROM ev UNION ALL SELECT 'broken', 'FAILED', 0::BIGINT")
def _(t: Tables):
    suite = {"sound": lambda: t.catalog, "broken": lambda: t.catalog.filter("no_such_column > 0")}
    return validate.suite_summary(t.spark, suite).drop("error")


@query("v13_fallback_row", f"WITH {EVAL} SELECT 2000 AS year, 1 AS month, 0::BIGINT AS monthly_count FROM (SELECT count(*) AS n FROM eva WHERE magnitude > 1000) WHERE n = 0")
def _(t: Tables):
    empty = evaluation.monthly_trends(t.evaluated.filter("magnitude > 1000")).select("year", "month", "monthly_count")
    return validate.with_fallback(empty, {"year": F.lit(2000), "month": F.lit(1), "monthly_count": F.lit(0)})
