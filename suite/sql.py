"""Common table expressions of the SQL counterparts, written for DuckDB."""

from __future__ import annotations


# Means of few values often lie exactly between two rounded numbers, and fall to either side with the order of the
# additions; both engines add this part of the last digit before they round.
TIE = 0.03141


def r(x: str, digits: int = 6) -> str:
    """Rounded double without negative zero. Like ``suite.base.settled``, it moves ties off the middle first."""
    moved = f"({x})+{TIE * 10 ** -digits!r}::DOUBLE" if digits >= 6 else x
    return f"CASE WHEN round({moved},{digits})=0 THEN 0.0::DOUBLE ELSE round({moved},{digits})::DOUBLE END"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


EV = """ev AS (
 SELECT event_id, 'ev' || event_id AS id, ts - to_days(CAST((event_id*17) % 1400 AS INTEGER)) AS time, ts - to_days(CAST((event_id*17) % 1400 AS INTEGER)) AS updated,
  CASE WHEN event_id % 4 = 0
   THEN CAST(-12 AS DOUBLE) + CAST((event_id*7919) % 10007 AS DOUBLE)*20/10007
   ELSE CAST(-11 AS DOUBLE) + CAST((user_id*37) % 180 AS DOUBLE)/10 + (CAST((event_id*7919) % 1000 AS DOUBLE)-500)/1000 END AS latitude,
  CASE WHEN event_id % 4 = 0
   THEN CAST(94 AS DOUBLE) + CAST((event_id*104729) % 10009 AS DOUBLE)*48/10009
   ELSE CAST(95 AS DOUBLE) + CAST((user_id*53) % 460 AS DOUBLE)/10 + (CAST((event_id*104729) % 1000 AS DOUBLE)-500)/1000 END AS longitude,
  CAST(json_extract_string(props,'$.k') AS DOUBLE)*CAST(json_extract_string(props,'$.k') AS DOUBLE)/CAST(14 AS DOUBLE) AS depth,
  CAST(3 AS DOUBLE) + value/80 AS magnitude,
  'mb' AS magnitude_type,
  'km ' || event_id || ' #zone, ' || event_type AS place,
  CAST(user_id*10 AS INTEGER) AS felt, CAST(user_id % 10 AS DOUBLE) AS cdi, CAST(user_id % 9 AS DOUBLE) AS mmi,
  CASE event_type WHEN 'error' THEN 'red' WHEN 'purchase' THEN 'orange' WHEN 'click' THEN 'yellow' WHEN 'view' THEN 'green' END AS alert,
  'reviewed' AS status, CASE WHEN event_type='error' THEN 1 ELSE 0 END AS tsunami,
  CAST(event_id % 2000 AS INTEGER) AS sig, 'us' AS net, CAST((event_id*11) % 40 AS INTEGER) AS nst,
  CAST((user_id*7) % 50 AS DOUBLE) AS dmin, CAST((event_id*17) % 200 AS DOUBLE)/100 AS rms,
  CAST((event_id*13) % 360 AS DOUBLE) AS gap, 'earthquake' AS type, user_id, event_type
 FROM events)"""

REGION = """CASE WHEN longitude BETWEEN 95 AND 106 AND latitude BETWEEN -6 AND 6 THEN 'Sumatra'
 WHEN longitude BETWEEN 106 AND 115 AND latitude BETWEEN -9 AND -5 THEN 'Java'
 WHEN longitude BETWEEN 108 AND 117 AND latitude BETWEEN -4 AND 5 THEN 'Kalimantan'
 WHEN longitude BETWEEN 118 AND 125 AND latitude BETWEEN -6 AND 2 THEN 'Sulawesi'
 WHEN longitude BETWEEN 125 AND 141 AND latitude BETWEEN -11 AND 2 THEN 'Eastern_Indonesia' ELSE 'Other' END"""

ZONE = """CASE WHEN longitude BETWEEN 95 AND 141 AND latitude BETWEEN -11 AND 6 THEN 'indonesia'
 WHEN longitude BETWEEN 129 AND 146 AND latitude BETWEEN 24 AND 46 THEN 'japan'
 WHEN longitude BETWEEN 116 AND 127 AND latitude BETWEEN 5 AND 19 THEN 'philippines'
 WHEN longitude BETWEEN -76 AND -66 AND latitude BETWEEN -56 AND -17 THEN 'chile' ELSE 'other' END"""

MAGNITUDE_CLASS = """CASE WHEN magnitude<0 THEN NULL WHEN magnitude<=3 THEN 'Very Minor' WHEN magnitude<=4 THEN 'Minor'
 WHEN magnitude<=5 THEN 'Light' WHEN magnitude<=6 THEN 'Moderate' WHEN magnitude<=7 THEN 'Strong' WHEN magnitude<=10 THEN 'Major' END"""

MAGNITUDE_HAZARD = """CASE WHEN magnitude<0 THEN NULL WHEN magnitude<=4 THEN 'Low' WHEN magnitude<=5 THEN 'Moderate'
 WHEN magnitude<=6 THEN 'Strong' WHEN magnitude<=7 THEN 'Major' WHEN magnitude<=10 THEN 'Great' END"""

DEPTH_CLASS = """CASE WHEN depth<0 THEN NULL WHEN depth<=30 THEN 'Very Shallow' WHEN depth<=70 THEN 'Shallow'
 WHEN depth<=300 THEN 'Intermediate' WHEN depth<=700 THEN 'Deep' END"""

MAGNITUDE_LEVEL = """CASE WHEN magnitude<3 THEN 'micro' WHEN magnitude<4 THEN 'minor' WHEN magnitude<5 THEN 'light'
 WHEN magnitude<6 THEN 'moderate' WHEN magnitude<7 THEN 'strong' WHEN magnitude<8 THEN 'major' ELSE 'great' END"""

DEPTH_LEVEL = """CASE WHEN depth<=10 THEN 'very_shallow' WHEN depth<=30 THEN 'shallow' WHEN depth<=70 THEN 'intermediate_shallow'
 WHEN depth<=150 THEN 'intermediate' WHEN depth<=300 THEN 'intermediate_deep' WHEN depth<=500 THEN 'deep' ELSE 'very_deep' END"""

MAGNITUDE_BAND = "CASE WHEN magnitude>=7 THEN 'Major' WHEN magnitude>=5 THEN 'Moderate' ELSE 'Minor' END"
DEPTH_BAND = "CASE WHEN depth<70 THEN 'Shallow' WHEN depth<300 THEN 'Intermediate' ELSE 'Deep' END"
HEMISPHERE = "CASE WHEN longitude<0 THEN 'Western Hemisphere' ELSE 'Eastern Hemisphere' END"
QUALITY = "CASE WHEN coalesce(gap>180,false) OR coalesce(rms>1.0,false) OR coalesce(nst<4,false) THEN 'Poor' ELSE 'Good' END"
ALERT_LEVEL = "CASE alert WHEN 'green' THEN 1 WHEN 'yellow' THEN 2 WHEN 'orange' THEN 3 WHEN 'red' THEN 4 ELSE 0 END"
INTENSITY = """(CASE WHEN felt>=1000 THEN 3 WHEN felt>=100 THEN 2 WHEN felt>=10 THEN 1 ELSE 0 END
 + CASE WHEN cdi>=8 THEN 4 WHEN cdi>=6 THEN 3 WHEN cdi>=4 THEN 2 WHEN cdi>=2 THEN 1 ELSE 0 END
 + CASE WHEN mmi>=8 THEN 4 WHEN mmi>=6 THEN 3 WHEN mmi>=4 THEN 2 WHEN mmi>=2 THEN 1 ELSE 0 END)"""

SEASON = """CASE WHEN month(time) IN (12,1,2) THEN 'winter' WHEN month(time) IN (3,4,5) THEN 'spring' WHEN month(time) IN (6,7,8) THEN 'summer' ELSE 'autumn' END"""

VALID = """latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND magnitude>0 AND depth>=0
 AND NOT isnan(magnitude) AND NOT isnan(depth) AND id IS NOT NULL"""

# Hazard profile.
ENH = f"""{EV}, enh0 AS (SELECT *, time + INTERVAL 7 HOUR AS datetime_local, {DEPTH_CLASS} AS depth_category,
  {MAGNITUDE_HAZARD} AS magnitude_hazard, {INTENSITY}::DOUBLE AS intensity_score, {ALERT_LEVEL} AS alert_level,
  {REGION} AS region, {QUALITY} AS data_quality FROM ev),
 enh AS (SELECT *, coalesce(magnitude,0)*2 + intensity_score*1.5::DOUBLE + alert_level + tsunami*3
  + CASE WHEN depth<=30 THEN 2 ELSE 0 END AS hazard_score FROM enh0)"""

# The enhanced catalog with every seventh event under two more ids.
COPIES = """copies AS (SELECT * FROM enh UNION ALL SELECT * REPLACE ('a' || id AS id) FROM enh WHERE event_id % 7 = 0
 UNION ALL SELECT * REPLACE (id || 'b' AS id) FROM enh WHERE event_id % 7 = 0)"""

# Batch ETL profile.
FEAT = f"""{EV}, clean0 AS (SELECT * EXCLUDE (alert, place),
  regexp_replace(coalesce(alert,'unknown'), '[^a-zA-Z0-9\\s,.-]', '', 'g') AS alert,
  regexp_replace(place, '[^a-zA-Z0-9\\s,.-]', '', 'g') AS place FROM ev WHERE {VALID}),
 clean AS (SELECT *, CASE WHEN alert IN ('green','GREEN') THEN 'green' WHEN alert IN ('yellow','YELLOW') THEN 'yellow'
  WHEN alert IN ('orange','ORANGE') THEN 'orange' WHEN alert IN ('red','RED') THEN 'red' ELSE 'unknown' END AS alert_standardized FROM clean0),
 feat AS (SELECT *, year(time)::INTEGER AS year, month(time)::INTEGER AS month, day(time)::INTEGER AS day, hour(time)::INTEGER AS hour,
  {MAGNITUDE_LEVEL} AS magnitude_category, {DEPTH_LEVEL} AS depth_category_detailed, {ZONE} AS geographic_zone, {SEASON} AS season,
  magnitude*0.4::DOUBLE + CASE WHEN depth<=50 THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END*0.3::DOUBLE
   + CASE alert_standardized WHEN 'red' THEN 1.0::DOUBLE WHEN 'orange' THEN 0.7::DOUBLE WHEN 'yellow' THEN 0.4::DOUBLE ELSE 0.1::DOUBLE END*0.3::DOUBLE AS risk_score
  FROM clean)"""

# Evaluation profile.
EVAL = f"""{EV}, eva AS (SELECT id, time, latitude, longitude, depth, magnitude, place, year(time)::INTEGER AS year, month(time)::INTEGER AS month,
  {MAGNITUDE_BAND} AS magnitude_category, {HEMISPHERE} AS geographic_zone, magnitude/10 + depth/700 AS risk_score,
  {DEPTH_BAND} AS depth_category_detailed, magnitude*1000 - depth*10 AS population_impact_estimate,
  CAST(trunc(latitude*100 + longitude) AS INTEGER) AS earthquake_cluster FROM ev)"""

# Processed table: density on the 0.1 degree grid and the hazard score.
PROC = f"""{EV}, val AS (SELECT *, {REGION} AS region, {MAGNITUDE_CLASS} AS magnitude_category, {DEPTH_CLASS} AS depth_category FROM ev WHERE {VALID}),
 org AS (SELECT min(latitude) AS lat0, min(longitude) AS lon0 FROM val),
 gridded AS (SELECT val.*, greatest(CAST(ceil((latitude-lat0)/0.1::DOUBLE) AS BIGINT)-1, 0) AS lat_grid,
  greatest(CAST(ceil((longitude-lon0)/0.1::DOUBLE) AS BIGINT)-1, 0) AS lon_grid FROM val, org),
 cells AS (SELECT lat_grid, lon_grid, count(*) AS grid_count FROM gridded GROUP BY ALL),
 dens AS (SELECT gridded.*, grid_count, grid_count/((0.1::DOUBLE*111)*(0.1::DOUBLE*111)) AS spatial_density FROM gridded LEFT JOIN cells USING (lat_grid, lon_grid)),
 proc AS (SELECT *, least(least(magnitude/2, 4.0::DOUBLE) + CASE WHEN depth<=30 THEN 2 WHEN depth<=70 THEN 1 ELSE 0 END
  + CASE region WHEN 'Java' THEN 2.0::DOUBLE WHEN 'Sumatra' THEN 1.5::DOUBLE WHEN 'Sulawesi' THEN 1.0::DOUBLE
    WHEN 'Eastern_Indonesia' THEN 0.5::DOUBLE WHEN 'Kalimantan' THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END
  + least(spatial_density*10, 2.0::DOUBLE), 10.0::DOUBLE) AS hazard_score FROM dens)"""

# Great-circle density clustering at 0.004 radians and 5 events. Use with WITH RECURSIVE.
LABELS = f"""{PROC}, pts AS (SELECT id, radians(latitude) AS p, radians(longitude) AS l,
  CAST(floor(latitude*4) AS BIGINT) AS gy, CAST(floor(longitude*4) AS BIGINT) AS gx FROM proc),
 pts9 AS (SELECT id, p, l, gy+dy AS gy, gx+dx AS gx FROM pts, (VALUES (-1),(0),(1)) AS a(dy), (VALUES (-1),(0),(1)) AS b(dx)),
 nb AS MATERIALIZED (SELECT a.id AS u, b.id AS v FROM pts9 a JOIN pts b USING (gy, gx)
  WHERE 2*asin(least(1, sqrt(pow(sin((b.p-a.p)/2),2) + cos(a.p)*cos(b.p)*pow(sin((b.l-a.l)/2),2)))) <= 0.004::DOUBLE),
 core AS MATERIALIZED (SELECT u FROM nb GROUP BY u HAVING count(*) >= 5),
 ce AS MATERIALIZED (SELECT u, v FROM nb WHERE u IN (SELECT u FROM core) AND v IN (SELECT u FROM core)),
 reach(u, l) AS (SELECT u, u FROM core UNION SELECT ce.v, reach.l FROM reach JOIN ce ON reach.u = ce.u WHERE reach.l < ce.v),
 corelab AS (SELECT u AS id, min(l) AS label FROM reach GROUP BY u),
 border AS (SELECT nb.u AS id, min(c.label) AS label FROM nb JOIN corelab c ON nb.v = c.id
  WHERE nb.u NOT IN (SELECT u FROM core) GROUP BY nb.u),
 alllab AS (SELECT *, true AS is_core FROM corelab UNION ALL SELECT *, false FROM border),
 numbers AS (SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS cluster_id FROM (SELECT DISTINCT label FROM corelab)),
 labels AS (SELECT proc.id, coalesce(cluster_id, -1) AS cluster_id, coalesce(is_core, false) AS is_core
  FROM proc LEFT JOIN alllab USING (id) LEFT JOIN numbers USING (label))"""

CLUSTER_RISK = "CASE WHEN max_magnitude>=6.5 THEN 'Extreme' WHEN max_magnitude>=5.5 THEN 'High' WHEN max_magnitude>=4.5 THEN 'Moderate' ELSE 'Low' END"

CLUSTERS = f"""{LABELS}, clustered AS (SELECT proc.*, cluster_id FROM proc JOIN labels USING (id) WHERE cluster_id <> -1),
 summ AS (SELECT cluster_id, avg(magnitude) AS avg_magnitude, max(magnitude) AS max_magnitude, CAST(count(id) AS INTEGER) AS cluster_size,
  avg(latitude) AS centroid_lat, avg(longitude) AS centroid_lon FROM clustered GROUP BY cluster_id),
 clus AS (SELECT c.id, c.cluster_id, 'Cluster-' || c.cluster_id AS cluster_label, {CLUSTER_RISK} AS risk_zone, centroid_lat, centroid_lon,
  cluster_size, avg_magnitude, max_magnitude FROM clustered c JOIN summ USING (cluster_id)),
 cls AS (SELECT id AS earthquake_id, risk_zone AS classified_risk_zone, 0.95::DOUBLE AS classification_confidence, '1.0.0' AS model_version FROM clus),
 zones AS (SELECT risk_zone AS risk_level, avg(avg_magnitude) AS avg_magnitude, CAST(count(id) AS INTEGER) AS event_count,
  avg(centroid_lat) AS center_lat, avg(centroid_lon) AS center_lon FROM clus WHERE risk_zone IN ('High','Extreme') GROUP BY risk_zone)"""
