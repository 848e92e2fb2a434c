"""Stateful streams of events: repeats dropped by id, and statistics per day, both bounded by a watermark.

The watermark trails the newest event time by a fixed delay. State older than it is removed, so what a stream holds
grows with the events of one delay, not with its age; records that arrive behind it are late, are left out of every
result, and are counted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DELAY = "2 days"
REMEMBERED = "spark.sql.streaming.numRecentProgressUpdates"


def without_repeats(stream: DataFrame, delay: str = DELAY, key: str = "id", time: str = "time") -> DataFrame:
    """The first record of every ``key``; an id that comes again within ``delay`` of its event time is dropped.

    Records without a time have no place among the others and are left out.
    """
    return stream.filter(F.col(time).isNotNull()).withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def daily_windows(stream: DataFrame, delay: str = DELAY, time: str = "time") -> DataFrame:
    """Statistics of every day, emitted once, when the watermark has passed the day's end.

    ``stream`` may already have a watermark on ``time``, as :func:`without_repeats` gives it one.
    """
    marked = stream if _has_watermark(stream, time) else stream.withWatermark(time, delay)
    days = marked.groupBy(F.window(time, "1 day").alias("_day")).agg(
        F.count("magnitude").alias("earthquake_count"), F.avg("magnitude").alias("avg_magnitude"),
        F.max("magnitude").alias("max_magnitude"), F.avg("depth").alias("avg_depth"),
    )
    return days.select(F.to_date("_day.start").alias("date"), *days.columns[1:])


def _has_watermark(stream: DataFrame, time: str) -> bool:
    return any("watermark" in key.lower() for key in stream.schema[time].metadata)


@dataclass
class Progress:
    """What a run took in: records read, records behind the watermark, and batches."""

    records: int
    late: int
    batches: int


def append_available(stream: DataFrame, path: str, checkpoint: str) -> Progress:
    """Process what is there, append finished rows to Parquet at ``path``, and say what came in.

    Started again with the same checkpoint, a run goes on where the last one ended, also after a failure: a batch
    that was committed is not written twice, one that was not is done again from the same files and state. Only so
    many batches are remembered; a longer run raises rather than count a part of them.
    """
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = writer.format("parquet").option("path", path).start()
    query.awaitTermination()
    seen = query.recentProgress
    limit = int(stream.sparkSession.conf.get(REMEMBERED))
    if len(seen) >= limit:
        raise ValueError(f"{limit} batches or more: raise {REMEMBERED}")
    # Operators are listed from the sink; the last one meets a late record first and drops it by itself.
    late = sum(p["stateOperators"][-1]["numRowsDroppedByWatermark"] for p in seen if p["stateOperators"])
    return Progress(sum(p["numInputRows"] for p in seen), late, len(seen))
