"""Collection windows of a date range."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def collection_windows(spark: SparkSession, start: str, end: str, days: int = 90, gap: int = 1) -> DataFrame:
    """(starttime, endtime) windows of ``days`` days; the next starts ``gap`` days after the last end."""
    first, last = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    starts = F.explode(F.sequence(first, last, F.expr(f"INTERVAL {days + gap} DAYS")))
    return spark.range(1).select(starts.alias("starttime"), last.alias("_last")).filter("starttime < _last").select(
        "starttime", F.least(F.date_add("starttime", days), F.col("_last")).alias("endtime")
    )


def with_window(df: DataFrame, start: str, end: str, days: int = 90, gap: int = 1, time: str = "time") -> DataFrame:
    """Tag events with the window that holds their day, by arithmetic instead of a range join."""
    first, last, day = F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.to_date(time)
    index = F.floor(F.date_diff(day, first) / (days + gap)).cast("int")
    opening = F.date_add(first, index * (days + gap))
    closing = F.least(F.date_add(opening, days), last)
    inside = (day >= first) & (opening < last) & (day <= closing)
    return df.withColumns({"starttime": F.when(inside, opening), "endtime": F.when(inside, closing)})
