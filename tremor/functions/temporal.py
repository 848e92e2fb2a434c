"""Date and time expressions. The session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tremor.constants import LOCAL_ZONE, SEASONS


def from_millis(ms: Column, truncate: bool = False) -> Column:
    """Epoch milliseconds to timestamp, keeping or dropping the fraction of a second."""
    stamp = F.timestamp_millis(ms)
    return F.date_trunc("second", stamp) if truncate else stamp


def local_time(time: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.from_utc_timestamp(time, zone)


def iso_text(time: Column) -> Column:
    return F.coalesce(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(""))


def calendar_parts(time: Column) -> dict[str, Column]:
    return {"year": F.year(time), "month": F.month(time), "day": F.dayofmonth(time), "hour": F.hour(time)}


def season_number(month: Column) -> Column:
    """1 for December to February, up to 4 for September to November."""
    return F.floor((month % 12 + 3) / 3).cast("int")


def season_name(month: Column) -> Column:
    chain = F
    for name, months in SEASONS.items():
        chain = chain.when(month.isin(*months), name)
    return chain


def temporal_struct(time: Column) -> Column:
    weekday = F.weekday(time)
    parts = calendar_parts(time)
    filled = F.struct(
        *[c.alias(n) for n, c in parts.items()],
        F.dayofyear(time).alias("day_of_year"),
        weekday.alias("day_of_week"),
        (weekday >= 5).alias("is_weekend"),
        season_number(parts["month"]).alias("season"),
    )
    return F.when(time.isNotNull(), filled)


def parse_time(text: Column) -> Column:
    """Text to timestamp; unreadable text becomes NULL."""
    return F.try_to_timestamp(text)


def within(time: Column, as_of: Column, interval: str) -> Column:
    """True for times no older than ``interval`` (such as ``30 DAYS``) before ``as_of``."""
    return time >= as_of - F.expr(f"INTERVAL {interval}")
