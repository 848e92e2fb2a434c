"""Streaming ingestion, run until the available files are consumed."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.base import Tables, query, rounded
from suite.sql import EV, r
from tremor.operators.filters import valid_stream_events
from tremor.sources import sinks
from tremor.sources.geojson import to_features
from tremor.streaming.ingest import read_feature_stream, start_ingest, transform_features
from tremor.streaming.stateful import append_available, daily_windows, without_repeats

VALID = "magnitude > 0 AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"
SHOWN = ["id", "magnitude", "place", "longitude", "latitude", "depth"]


def landed(t: Tables) -> str:
    path = sinks.scratch_path(t.catalog, "landing")
    to_features(t.catalog).write.json(path)
    return path


def ingested(t: Tables, files_per_trigger: int | None = None):
    stream = transform_features(read_feature_stream(t.spark, landed(t), files_per_trigger))
    out = sinks.scratch_path(t.catalog, "ingested")
    running = start_ingest(stream, sinks.scratch_path(t.catalog, "progress"), out, available_now=True)
    running.awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(out)


@query("r1_stream_ingest", f"WITH {EV} SELECT {', '.join(SHOWN)}, epoch_us(time)//1000 AS time_ms FROM ev WHERE {VALID}")
def _(t: Tables):
    return ingested(t).select(*SHOWN, F.unix_millis("time").alias("time_ms"))


@query("s15_stream_source", f"WITH {EV} SELECT count(*) AS events, count(DISTINCT id) AS ids FROM ev WHERE {VALID}")
def _(t: Tables):
    return ingested(t, files_per_trigger=1).agg(F.count(F.lit(1)).alias("events"), F.countDistinct("id").alias("ids"))


@query("s16_stream_sink", f"WITH {EV} SELECT id, true AS stamped FROM ev WHERE {VALID}")
def _(t: Tables):
    return ingested(t).select("id", F.col("processed_at").isNotNull().alias("stamped"))


# What comes first, and the newest event of it; the rest comes later, with repeats of the last day and late copies.
ARRIVALS = f"""{EV}, v AS (SELECT * FROM ev WHERE {VALID}),
 f AS (SELECT * FROM v WHERE time < (SELECT max(time) FROM v) - INTERVAL 30 DAY), m AS (SELECT max(time) AS top FROM f)"""


def arrivals(t: Tables):
    """(first, second) parts of the catalog: the second repeats what the first had last and brings copies of old events."""
    rows = valid_stream_events(t.catalog)
    times = rows.agg(F.max("time").alias("m")).first()["m"]
    cut = F.lit(times) - F.expr("INTERVAL 30 DAYS")
    first = rows.filter(F.col("time") < cut)
    top = F.lit(first.agg(F.max("time").alias("m")).first()["m"])
    late = first.filter(F.col("time") < top - F.expr("INTERVAL 10 DAYS")).withColumn("id", F.concat(F.lit("late-"), "id"))
    repeats = first.filter(F.col("time") >= top - F.expr("INTERVAL 1 DAY"))
    return first, rows.filter(F.col("time") >= cut).unionByName(repeats).unionByName(late)


def in_two_runs(t: Tables, make):
    """The rows appended by two runs of ``make(stream)`` over one checkpoint, and what each run took in."""
    landing, out, checkpoint = (sinks.scratch_path(t.catalog, x) for x in ("landing", "appended", "progress"))
    seen = []
    for part in arrivals(t):
        to_features(part).write.mode("append").json(landing)
        stream = make(transform_features(read_feature_stream(t.spark, landing)))
        seen.append(append_available(stream, out, checkpoint))
    return t.spark.read.schema(stream.schema).parquet(out), seen


@query("r1_stream_dedup", f"""WITH {ARRIVALS} SELECT id, magnitude, (SELECT count(*) FROM f, m WHERE time < top - INTERVAL 10 DAY) AS late,
 (SELECT count(*) FROM f, m WHERE time >= top - INTERVAL 1 DAY) AS repeated FROM v""")
def _(t: Tables):
    """Events that arrive twice are stored once; events older than the watermark are counted and left out."""
    rows, (one, two) = in_two_runs(t, without_repeats)
    stored = rows.count()
    late = one.late + two.late
    repeated = one.records + two.records - late - stored
    return rows.select("id", "magnitude", F.lit(late).cast("bigint").alias("late"), F.lit(repeated).cast("bigint").alias("repeated"))


@query("r1_stream_daily", f"""WITH {ARRIVALS}, w AS (SELECT max(time) - INTERVAL 2 DAY AS mark FROM v)
 SELECT CAST(CAST(time AS DATE) AS VARCHAR) AS date, count(magnitude) AS earthquake_count, {r('avg(magnitude)')} AS avg_magnitude, max(magnitude) AS max_magnitude, {r('avg(depth)')} AS avg_depth
 FROM v, w WHERE CAST(time AS DATE) + INTERVAL 1 DAY <= mark GROUP BY 1""")
def _(t: Tables):
    """Every day that is over by the watermark, once, without repeats and late copies: the batch statistics of those days."""
    rows, _ = in_two_runs(t, lambda stream: daily_windows(without_repeats(stream)))
    return rounded(rows, "avg_magnitude", "avg_depth").withColumn("date", F.col("date").cast("string"))
