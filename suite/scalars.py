"""Column functions, each over the whole catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.base import Tables, query, scalar, settled
from suite.sql import (
    ALERT_LEVEL, DEPTH_BAND, DEPTH_CLASS, DEPTH_LEVEL, ENH, EV, FEAT, HEMISPHERE, INTENSITY, MAGNITUDE_BAND,
    MAGNITUDE_CLASS, MAGNITUDE_HAZARD, MAGNITUDE_LEVEL, PROC, QUALITY, REGION, ZONE, r, stamp as sql_stamp,
)
from tremor import constants as K
from tremor.functions import classify, scores, temporal, text
from tremor.learning.prepare import bucketize

c = F.col


def r6(x):
    return settled(x)


def text_stamp(x):
    return F.date_format(x, "yyyy-MM-dd HH:mm:ss")


# Date and time.
scalar("d1_epoch_to_time", {
    "time_ms": (lambda: F.unix_millis(temporal.from_millis(F.unix_millis(c("time")))), "epoch_us(time)//1000"),
    "whole_seconds": (lambda: text_stamp(temporal.from_millis(F.unix_millis(c("time")), truncate=True)), sql_stamp("time")),
})
scalar("d2_calendar_parts", {
    part: (lambda part=part: temporal.calendar_parts(temporal.from_millis(F.unix_millis(c("time"))))[part], f"CAST({part}(time) AS INTEGER)")
    for part in ("year", "month", "day", "hour")
})
scalar("d3_local_time", {
    "datetime_local": (lambda: text_stamp(temporal.local_time(c("time"))), sql_stamp("time + INTERVAL 7 HOUR")),
    **{p: (lambda p=p: temporal.calendar_parts(temporal.local_time(c("time")))[p], f"CAST({p}(time + INTERVAL 7 HOUR) AS INTEGER)")
       for p in ("year", "month", "hour")},
})
scalar("d4_iso_text", {"iso_time": (lambda: temporal.iso_text(c("time")), "coalesce(strftime(time, '%Y-%m-%dT%H:%M:%SZ'), '')")})


@query("d5_temporal_struct", f"""WITH {EV} SELECT id, year(time)::INTEGER AS year, month(time)::INTEGER AS month, day(time)::INTEGER AS day,
 hour(time)::INTEGER AS hour, dayofyear(time)::INTEGER AS day_of_year, (isodow(time)-1)::INTEGER AS day_of_week,
 isodow(time)>=6 AS is_weekend, ((month(time)%12+3)//3)::INTEGER AS season FROM ev""")
def _(t: Tables):
    return t.catalog.select("id", temporal.temporal_struct(c("time")).alias("s")).select("id", "s.*")


scalar("d6_season_name", {"season": (
    lambda: temporal.season_name(F.month(c("time"))),
    "CASE WHEN month(time) IN (12,1,2) THEN 'winter' WHEN month(time) IN (3,4,5) THEN 'spring' WHEN month(time) IN (6,7,8) THEN 'summer' WHEN month(time) IN (9,10,11) THEN 'autumn' END",
)})


@query("d7_processing_time", f"WITH {EV} SELECT id, true AS stamped FROM ev")
def _(t: Tables):
    stamped = t.catalog.select("id", F.current_timestamp().alias("processed_at"))
    return stamped.select("id", (c("processed_at") > F.timestamp_seconds(F.lit(1_600_000_000))).alias("stamped"))


scalar("d8_parse_time", {
    "from_text": (lambda: text_stamp(temporal.parse_time(F.date_format(c("time"), "yyyy-MM-dd HH:mm:ss"))), sql_stamp("time")),
    "from_place": (lambda: text_stamp(temporal.parse_time(c("place"))), sql_stamp("try_cast(place AS TIMESTAMP)")),
})
scalar("d9_day_and_month_names", {
    "day_name": (lambda: F.date_format(c("time"), "EEEE"), "dayname(time)"),
    "month_name": (lambda: F.date_format(c("time"), "MMMM"), "monthname(time)"),
    "day": (lambda: F.to_date(c("time")).cast("string"), "CAST(CAST(time AS DATE) AS VARCHAR)"),
})
scalar("d10_month_period", {
    "month_start": (lambda: text_stamp(F.date_trunc("month", c("time"))), sql_stamp("date_trunc('month', time)")),
})


@query("d11_recent_window", f"WITH {EV} SELECT id FROM ev WHERE time >= (SELECT max(time) FROM ev) - INTERVAL 7 DAY")
def _(t: Tables):
    as_of = t.catalog.agg(F.max("time").alias("m")).scalar()
    return t.catalog.filter(temporal.within(c("time"), as_of, "7 DAYS")).select("id")


# Text, casts, nulls, lookups.
scalar("x1_strip_place", {"place": (lambda: text.strip_place(c("place")), r"regexp_replace(place, '[^a-zA-Z0-9\s,-]', '', 'g')")})
TEXT = ("place", "alert", "status", "magnitude_type", "type")
scalar("x2_strip_text", {
    n: (lambda n=n: text.strip_text(c(n)), rf"regexp_replace({n}, '[^a-zA-Z0-9\s,.-]', '', 'g')") for n in TEXT
})
scalar("x3_standard_alert", {"alert_standardized": (
    lambda: text.standard_alert(F.when(c("tsunami") == 1, F.upper("alert")).otherwise(F.initcap("alert"))),
    "CASE WHEN alert='red' THEN 'red' ELSE 'unknown' END",
)})
scalar("x4_alert_level", {"alert_level": (lambda: text.alert_level(c("alert")), ALERT_LEVEL)})


@query("x5_fill_unknown", f"WITH {EV} SELECT id, coalesce(alert,'unknown') AS alert, coalesce(status,'unknown') AS status FROM ev")
def _(t: Tables):
    return t.catalog.select("id", "alert", "status").fillna("unknown", ["alert", "status"])


scalar("x6_replace_text", {"place": (
    lambda: text.replace_text(c("place"), "purchase", "buy"),
    "CASE WHEN place LIKE '%purchase%' THEN replace(place,'purchase','buy') ELSE place END",
)})
scalar("x7_build_labels", {
    "cluster_label": (lambda: text.cluster_label(c("sig")), "'Cluster-' || sig"),
    "copy_id": (lambda: F.concat(c("id"), F.lit("_aug_"), F.lit("1")), "id || '_aug_1'"),
})
scalar("x8_defaults", {
    "alert": (lambda: F.coalesce(c("alert"), F.lit("none")), "coalesce(alert,'none')"),
    "magnitude": (lambda: F.coalesce(c("magnitude"), F.lit(0.0)), "coalesce(magnitude, 0)"),
})
scalar("x9_round_half_up", {
    "half": (lambda: text.round_numeric((c("sig") + 1) / 4, 1), "CAST(round(CAST((sig+1) AS DECIMAL(12,4))/4, 1) AS DOUBLE)"),
    "magnitude_2": (lambda: text.round_numeric(c("magnitude").cast("decimal(18,9)"), 2).cast("double"), "CAST(round(CAST(magnitude AS DECIMAL(18,9)), 2) AS DOUBLE)"),
})
scalar("x10_struct_to_text", {"boundary": (
    lambda: F.coalesce(F.to_json(F.struct(c("sig"), c("alert"))), F.lit("{}")),
    """CASE WHEN alert IS NULL THEN '{"sig":' || sig || '}' ELSE '{"sig":' || sig || ',"alert":"' || alert || '"}' END""",
)})


@query("x11_defaults_when_absent", f"WITH {EV} SELECT id, 'Unknown' AS risk_zone, {REGION} AS region, magnitude*2 AS hazard_score FROM ev")
def _(t: Tables):
    from pyspark.sql import types as T

    from tremor.operators.filters import normalise_schema

    wanted = T.StructType([
        T.StructField("id", T.StringType()), T.StructField("risk_zone", T.StringType()),
        T.StructField("region", T.StringType()), T.StructField("hazard_score", T.DoubleType()),
    ])
    source = t.catalog.withColumn("region", classify.region(c("longitude"), c("latitude")))
    return normalise_schema(source, wanted, {"risk_zone": F.lit("Unknown"), "hazard_score": c("magnitude") * 2})


@query("x12_nan_to_null", f"WITH {EV} SELECT id, CASE WHEN tsunami=1 THEN NULL ELSE depth END AS depth, magnitude FROM ev")
def _(t: Tables):
    broken = t.catalog.select("id", F.when(c("tsunami") == 1, F.lit(float("nan"))).otherwise(c("depth")).alias("depth"), "magnitude")
    return text.nan_to_null(broken)


# Classes.
scalar("p4_region", {"region": (lambda: classify.region(c("longitude"), c("latitude")), REGION)})
scalar("p5_geographic_zone", {"geographic_zone": (lambda: classify.geographic_zone(c("longitude"), c("latitude")), ZONE)})
scalar("p6_hemisphere", {"geographic_zone": (lambda: classify.hemisphere(c("longitude") - 120), HEMISPHERE.replace("longitude<0", "longitude-120<0"))})
scalar("p7_tectonic_setting", {
    "tectonic_setting": (lambda: classify.tectonic_setting(c("longitude"), c("latitude")),
                         "CASE WHEN longitude BETWEEN 95 AND 141 AND latitude BETWEEN -11 AND 6 THEN 'subduction_zone' WHEN longitude BETWEEN -180 AND -60 AND latitude BETWEEN -60 AND 60 THEN 'transform_fault' WHEN longitude BETWEEN 120 AND 160 AND latitude BETWEEN -10 AND 50 THEN 'volcanic_arc' ELSE 'intraplate' END"),
    "mirrored": (lambda: classify.tectonic_setting(-c("longitude"), c("latitude")),
                 "CASE WHEN -longitude BETWEEN -180 AND -60 AND latitude BETWEEN -60 AND 60 THEN 'transform_fault' ELSE 'intraplate' END"),
})
scalar("p8_regional_risk", {"regional_risk": (
    lambda: classify.regional_risk(c("longitude"), c("latitude")),
    "CASE WHEN longitude BETWEEN 120 AND 160 AND latitude BETWEEN -10 AND 50 THEN 0.9::DOUBLE WHEN longitude BETWEEN -180 AND -120 AND latitude BETWEEN -60 AND 60 THEN 0.8::DOUBLE WHEN longitude BETWEEN 95 AND 141 AND latitude BETWEEN -11 AND 6 THEN 0.95::DOUBLE ELSE 0.3::DOUBLE END",
)})
scalar("m1_magnitude_class", {"magnitude_category": (lambda: classify.magnitude_class(c("magnitude")), MAGNITUDE_CLASS)})
scalar("m2_magnitude_level", {"magnitude_category": (lambda: classify.magnitude_level(c("magnitude")), MAGNITUDE_LEVEL)})
scalar("m3_magnitude_band", {"magnitude_category": (lambda: classify.magnitude_band(c("magnitude")), MAGNITUDE_BAND)})
scalar("m4_magnitude_hazard", {"magnitude_hazard": (lambda: classify.magnitude_hazard(c("magnitude")), MAGNITUDE_HAZARD)})
scalar("m5_depth_class", {"depth_category": (lambda: classify.depth_class(c("depth")), DEPTH_CLASS)})
scalar("m6_depth_level", {"depth_category_detailed": (lambda: classify.depth_level(c("depth")), DEPTH_LEVEL)})
scalar("m7_depth_band", {"depth_category_detailed": (lambda: classify.depth_band(c("depth")), DEPTH_BAND)})


def _bucket(x: str, splits) -> str:
    arms = " ".join(f"WHEN {x}<{s} THEN {i}" for i, s in enumerate(splits[1:-1]))
    return f"CAST(CASE {arms} ELSE {len(splits) - 2} END AS DOUBLE)"


@query("m8_buckets", f"WITH {EV} SELECT id, {_bucket('magnitude', K.MAGNITUDE_SPLITS)} AS magnitude_bucket, {_bucket('depth', K.DEPTH_SPLITS)} AS depth_bucket FROM ev")
def _(t: Tables):
    return bucketize(t.catalog).select("id", "magnitude_bucket", "depth_bucket")


# Scores and physics.
scalar("m9_distance_from_jakarta", {
    "degrees": (lambda: r6(scores.distance_from_jakarta(c("latitude"), c("longitude"), "degrees")), r("sqrt(pow(latitude+6.2088::DOUBLE,2)+pow(longitude-106.8456::DOUBLE,2))")),
    "km": (lambda: r6(scores.distance_from_jakarta(c("latitude"), c("longitude"))), r("sqrt(pow(latitude+6.2088::DOUBLE,2)+pow(longitude-106.8456::DOUBLE,2))*111")),
})
scalar("m10_ring_of_fire", {"ring_of_fire_distance": (
    lambda: r6(scores.ring_of_fire_distance(c("latitude"), c("longitude"))), r("sqrt(pow(longitude-140,2)+pow(latitude-35,2))"))})
scalar("m11_ring_of_fire_axis", {"distance_from_ring_of_fire": (
    lambda: scores.ring_of_fire_axis_distance(c("latitude"), c("longitude")), "least(abs(latitude+5), abs(longitude-120))")})
scalar("m12_magnitude_squared", {"magnitude_squared": (lambda: scores.magnitude_squared(c("magnitude")), "magnitude*magnitude")})
scalar("m13_log_energy", {"energy_release_log": (lambda: scores.log_energy(c("magnitude")), "1.5::DOUBLE*magnitude+4.8::DOUBLE")})
scalar("m14_seismic_moment", {"moment_log10": (
    lambda: settled(F.log10(scores.seismic_moment(c("magnitude"))), 9), r("log10(pow(10, 1.5::DOUBLE*magnitude+9.1::DOUBLE))", 9))})
scalar("m15_stress_drop", {"stress_drop": (
    lambda: r6(scores.stress_drop(c("magnitude"), c("depth"))), r("pow(10, magnitude-5)*(1+depth/100)"))})
scalar("m16_intensity_composite", {"intensity_composite": (
    lambda: r6(scores.intensity_composite(c("magnitude"), c("felt"), c("sig"), c("alert"))),
    r("""CASE WHEN magnitude<>0 THEN least(magnitude/9,1)*0.4::DOUBLE ELSE 0 END
     + CASE WHEN felt<>0 THEN least(log10(felt::DOUBLE+1)/5,1)*0.2::DOUBLE ELSE 0 END
     + CASE WHEN sig<>0 THEN least(sig/2000.0::DOUBLE,1)*0.2::DOUBLE ELSE 0 END
     + CASE alert WHEN 'green' THEN 0.2::DOUBLE WHEN 'yellow' THEN 0.5::DOUBLE WHEN 'orange' THEN 0.8::DOUBLE WHEN 'red' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END*0.2::DOUBLE"""))})
scalar("m17_data_quality_score", {"data_quality_score": (
    lambda: r6(scores.data_quality_score(c("gap"), c("rms"), c("nst"))),
    r("greatest(1.0::DOUBLE - CASE WHEN gap>180 THEN 0.3::DOUBLE ELSE 0 END - CASE WHEN rms>1 THEN 0.2::DOUBLE ELSE 0 END + CASE WHEN nst>=10 THEN 0.1::DOUBLE ELSE 0 END, 0)"))})
scalar("m18_population_exposure", {"exposure": (
    lambda: F.round(scores.population_exposure(c("latitude"), c("longitude"), c("magnitude")), 2),
    r("CASE WHEN magnitude<>0 THEN (CASE WHEN longitude BETWEEN 106 AND 115 AND latitude BETWEEN -9 AND -5 THEN 1000 WHEN longitude BETWEEN 139 AND 141 AND latitude BETWEEN 35 AND 36 THEN 6000 WHEN longitude BETWEEN -118 AND -117 AND latitude BETWEEN 33 AND 34 THEN 3000 ELSE 100 END)*(pi()*(pow(10,magnitude-3)*pow(10,magnitude-3)))/1000 ELSE 0 END", 2))})
scalar("m21_tectonic_activity", {"tectonic_activity_score": (
    lambda: scores.tectonic_activity(classify.geographic_zone(c("longitude"), c("latitude"))),
    f"CASE {ZONE} WHEN 'indonesia' THEN 0.95::DOUBLE WHEN 'japan' THEN 0.90::DOUBLE WHEN 'philippines' THEN 0.85::DOUBLE WHEN 'chile' THEN 0.80::DOUBLE ELSE 0.30::DOUBLE END")})
scalar("m19_zone_impact", {"population_impact_estimate": (
    lambda: scores.zone_impact(c("magnitude"), classify.geographic_zone(c("longitude"), c("latitude"))),
    f"magnitude * CASE {ZONE} WHEN 'indonesia' THEN 1000 WHEN 'japan' THEN 800 WHEN 'philippines' THEN 600 ELSE 200 END")})
scalar("m20_depth_impact", {"population_impact_estimate": (lambda: scores.depth_impact(c("magnitude"), c("depth")), "magnitude*1000 - depth*10")})


@query("m22_weighted_risk", f"WITH {FEAT} SELECT id, {r('risk_score')} AS risk_score FROM feat")
def _(t: Tables):
    return t.features.select("id", r6(c("risk_score")).alias("risk_score"))


scalar("m23_scaled_risk", {"risk_score": (lambda: scores.scaled_risk(c("magnitude"), c("depth")), "magnitude/10 + depth/700")})
scalar("m24_intensity_score", {"intensity_score": (lambda: scores.intensity_score(c("felt"), c("cdi"), c("mmi")), INTENSITY)})


@query("m25_density_hazard", f"WITH {PROC} SELECT id, {r('hazard_score')} AS hazard_score FROM proc")
def _(t: Tables):
    return t.processed.select("id", r6(c("hazard_score")).alias("hazard_score"))


@query("m26_impact_hazard", f"WITH {ENH} SELECT id, hazard_score FROM enh")
def _(t: Tables):
    return t.enhanced.select("id", "hazard_score")


scalar("m27_cluster_risk", {"risk_zone": (
    lambda: classify.cluster_risk(c("magnitude")),
    "CASE WHEN magnitude>=6.5 THEN 'Extreme' WHEN magnitude>=5.5 THEN 'High' WHEN magnitude>=4.5 THEN 'Moderate' ELSE 'Low' END")})
scalar("m28_event_risk", {"risk_zone": (
    lambda: classify.event_risk(c("magnitude"), c("depth")),
    "CASE WHEN magnitude>=7 OR (magnitude>=6 AND depth<50) THEN 'Extreme' WHEN magnitude>=5.5 OR (magnitude>=5 AND depth<70) THEN 'High' WHEN magnitude>=4 THEN 'Moderate' ELSE 'Low' END")})

BASIC = f"""id, {r('sqrt(pow(latitude+6.2088::DOUBLE,2)+pow(longitude-106.8456::DOUBLE,2))')} AS distance_from_jakarta,
 magnitude/(depth+1) AS magnitude_depth_ratio, CASE WHEN depth<70 THEN 1 ELSE 0 END AS shallow_earthquake"""


@query("m29_basic_features", f"WITH {PROC} SELECT {BASIC}, {r('spatial_density')} AS spatial_density FROM proc")
def _(t: Tables):
    return scores.with_basic_features(t.processed).select(
        "id", r6(c("distance_from_jakarta")).alias("distance_from_jakarta"), "magnitude_depth_ratio", "shallow_earthquake",
        r6(c("spatial_density")).alias("spatial_density"))


@query("m30_extended_features", f"""WITH {PROC} SELECT {BASIC}, least(abs(latitude+5), abs(longitude-120)) AS distance_from_ring_of_fire,
 {r('spatial_density*(magnitude*magnitude)')} AS energy_density, CASE WHEN magnitude>5 THEN 1 ELSE 0 END AS high_magnitude,
 latitude*longitude AS lat_lon_interaction, {r('hazard_score*spatial_density')} AS hazard_spatial_interaction FROM proc""")
def _(t: Tables):
    return scores.with_extended_features(t.processed).select(
        "id", "magnitude_depth_ratio", "shallow_earthquake", "distance_from_ring_of_fire", "high_magnitude", "lat_lon_interaction",
        *[r6(c(x)).alias(x) for x in ("distance_from_jakarta", "energy_density", "hazard_spatial_interaction")])


scalar("m31_coarse_cell", {"earthquake_cluster": (lambda: scores.coarse_cell(c("latitude"), c("longitude")), "CAST(trunc(latitude*100+longitude) AS INTEGER)")})
scalar("m32_surface_distance", {"distance_from_surface": (
    lambda: scores.surface_distance(F.when(c("tsunami") == 0, c("depth"))), "CASE WHEN tsunami=0 THEN depth ELSE 0 END")})
scalar("p12_quality_flag", {"data_quality": (lambda: classify.quality_flag(c("gap"), c("rms"), c("nst")), QUALITY)})
