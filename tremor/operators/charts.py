"""The data behind charts: histograms, calendars, box plots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.operators.ranking import group_quantiles_wide
from tremor.workspace import constants

# Calendar order of the buckets, Monday first.
CALENDARS = {
    "month": [str(m) for m in range(1, 13)],
    "hour": [str(h) for h in range(24)],
    "weekday": ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"],
    "month_name": [
        "January", "February", "March", "April", "May", "June",
        "July", "August", "September", "October", "November", "December",
    ],
}
BUCKETS = {
    "month": lambda t: F.month(t).cast("string"),
    "hour": lambda t: F.hour(t).cast("string"),
    "weekday": lambda t: F.date_format(t, "EEEE"),
    "month_name": lambda t: F.date_format(t, "MMMM"),
    "year": lambda t: F.year(t).cast("string"),
}


def calendar_counts(df: DataFrame, unit: str, time: str = "time") -> DataFrame:
    """(position, bucket, events) with every bucket of the calendar; years are those that occur."""
    found = df.filter(F.col(time).isNotNull()).groupBy(BUCKETS[unit](time).alias("bucket")).agg(
        F.count(F.lit(1)).alias("events")
    )
    if unit not in CALENDARS:
        return found.select(F.col("bucket").cast("int").alias("position"), "bucket", "events")
    spine = df.sparkSession.createDataFrame(list(enumerate(CALENDARS[unit])), "position int, bucket string")
    return spine.join(F.broadcast(found), "bucket", "left").select(
        "position", "bucket", F.coalesce("events", F.lit(0)).alias("events")
    )


def peak_bucket(counts: DataFrame) -> DataFrame:
    """The fullest bucket, the earliest among equals."""
    return counts.agg(
        F.min_by("bucket", F.struct(-F.col("events"), F.col("position"))).alias("bucket"),
        F.max("events").alias("events"),
    )


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """(bin, low, high, events) of equal width; the last bin includes its upper edge."""
    present = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("x"))
    ends = constants(present.agg(F.min("x").alias("low"), F.max("x").alias("high")))
    low, width = ends["low"], (ends["high"] - ends["low"]) / bins
    # All values equal: one bin takes everything.
    index = F.coalesce(F.floor(F.try_divide(F.col("x") - low, width)), F.lit(0))
    counted = present.groupBy(F.least(index, F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("events")
    )
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(F.broadcast(counted), "bin", "left").select(
        "bin", (low + F.col("bin") * width).alias("low"), (low + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("events", F.lit(0)).alias("events"),
    )


def five_numbers(df: DataFrame, group: str, value: str) -> DataFrame:
    """Minimum, quartiles and maximum of ``value`` per group."""
    return group_quantiles_wide(
        df, [group], value, {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}
    )


def points(df: DataFrame, columns: list[str], order: str) -> DataFrame:
    """Complete rows of a scatter or line chart in order."""
    return df.select(*columns).dropna().orderBy(order)


def marker_sample(df: DataFrame, n: int = 500, seed: int = 42) -> DataFrame:
    """A fixed-size sample that depends only on the ids and the seed."""
    return df.orderBy(F.md5(F.concat(F.col("id").cast("string"), F.lit(f"/{seed}"))), "id").limit(n)
