"""Event catalog derived from a generic ``events`` table.

Integer arithmetic on the keys places every event, so that the catalog is the
same on any engine. A quarter of the events is spread over the whole map and
the rest forms swarms around a place that belongs to the user id. The times are
moved back by up to 1400 days, so that the catalog covers several years.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def catalog_from_events(events: DataFrame) -> DataFrame:
    """The canonical catalog plus the numeric ``event_id``."""
    e, u = F.col("event_id"), F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("double")
    spread = e % 4 == 0
    wide_lat = F.lit(-12.0) + ((e * 7919) % 10007).cast("double") * 20 / 10007
    wide_lon = F.lit(94.0) + ((e * 104729) % 10009).cast("double") * 48 / 10009
    near_lat = F.lit(-11.0) + ((u * 37) % 180).cast("double") / 10 + (((e * 7919) % 1000).cast("double") - 500) / 1000
    near_lon = F.lit(95.0) + ((u * 53) % 460).cast("double") / 10 + (((e * 104729) % 1000).cast("double") - 500) / 1000
    kind = F.col("event_type")
    time = F.col("ts").cast("timestamp") - F.make_dt_interval(days=((e * 17) % 1400).cast("int"))
    return events.select(
        "event_id",
        F.concat(F.lit("ev"), e.cast("string")).alias("id"),
        time.alias("time"),
        time.alias("updated"),
        F.when(spread, wide_lat).otherwise(near_lat).alias("latitude"),
        F.when(spread, wide_lon).otherwise(near_lon).alias("longitude"),
        (k * k / F.lit(14.0)).alias("depth"),
        (F.lit(3.0) + F.col("value") / 80).alias("magnitude"),
        F.lit("mb").alias("magnitude_type"),
        F.concat(F.lit("km "), e.cast("string"), F.lit(" #zone, "), kind).alias("place"),
        (u * 10).cast("int").alias("felt"),
        (u % 10).cast("double").alias("cdi"),
        (u % 9).cast("double").alias("mmi"),
        F.when(kind == "error", "red").when(kind == "purchase", "orange")
        .when(kind == "click", "yellow").when(kind == "view", "green").alias("alert"),
        F.lit("reviewed").alias("status"),
        F.when(kind == "error", 1).otherwise(0).alias("tsunami"),
        (e % 2000).cast("int").alias("sig"),
        F.lit("us").alias("net"),
        ((e * 11) % 40).cast("int").alias("nst"),
        ((u * 7) % 50).cast("double").alias("dmin"),
        (((e * 17) % 200).cast("double") / 100).alias("rms"),
        ((e * 13) % 360).cast("double").alias("gap"),
        F.lit("earthquake").alias("type"),
    )
