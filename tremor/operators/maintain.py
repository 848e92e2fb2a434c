"""Table maintenance as snapshot-to-snapshot functions.

Each returns (new snapshot, affected rows). A condition that is NULL for a row
leaves the row alone, as in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.functions.classify import cluster_risk
from tremor.functions.temporal import within
from tremor.functions.text import replace_text
from tremor.operators.dedup import duplicates, without_duplicates
from tremor.operators.filters import invalid_record

CONTENT = [
    "place", "datetime_local", "latitude", "longitude", "region", "depth", "magnitude", "tsunami",
    "depth_category", "alert_level", "magnitude_hazard", "hazard_score", "intensity_score",
]

Change = tuple[DataFrame, DataFrame]


def _holds(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def insert(snapshot: DataFrame, rows: DataFrame) -> Change:
    added = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in snapshot.schema.fields])
    return snapshot.unionByName(added), added


def insert_unless(snapshot: DataFrame, rows: DataFrame, blocker: DataFrame) -> Change:
    """Insert only if ``blocker`` is empty (NOT EXISTS)."""
    return insert(snapshot, rows.filter(~blocker.limit(1).exists()))


def recent_high_risk(snapshot: DataFrame, as_of: Column, region: str = "Java") -> DataFrame:
    """Strong shallow events of the last day in a region."""
    return snapshot.filter(
        (F.col("region") == region) & (F.col("magnitude") >= 6.0)
        & F.col("depth_category").isin("Very Shallow", "Shallow")
        & within(F.col("datetime_local"), as_of, "24 HOURS")
    ).select("id")


def update(snapshot: DataFrame, condition: Column, changes: dict[str, Column]) -> Change:
    hit = _holds(condition)
    types = dict(zip(snapshot.columns, [f.dataType for f in snapshot.schema.fields]))
    new = {c: v.cast(types[c]) for c, v in changes.items()}
    after = snapshot.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in new.items()})
    return after, snapshot.filter(hit).withColumns(new)


def delete(snapshot: DataFrame, condition: Column) -> Change:
    hit = _holds(condition)
    return snapshot.filter(~hit), snapshot.filter(hit)


def fix_depth_category(snapshot: DataFrame) -> Change:
    d = F.col("depth")
    category = (
        F.when(d <= 30, "Very Shallow").when(d <= 70, "Shallow").when(d <= 300, "Intermediate").otherwise("Deep")
    )
    return update(snapshot, (d > 30) & (d <= 70) & (F.col("depth_category") != "Shallow"), {"depth_category": category})


def rename_place(snapshot: DataFrame, old: str, new: str) -> Change:
    return update(snapshot, F.col("place").contains(old), {"place": replace_text(F.col("place"), old, new)})


def round_depth(snapshot: DataFrame, region: str = "Sumatra", digits: int = 2) -> Change:
    rounded = F.round("depth", digits)
    return update(snapshot, (F.col("region") == region) & (F.col("depth") != rounded), {"depth": rounded})


def delete_duplicates(snapshot: DataFrame, content: list[str] | None = None) -> Change:
    content = content or CONTENT
    return without_duplicates(snapshot, content), duplicates(snapshot, content)


def delete_old_minor(snapshot: DataFrame, as_of: Column) -> Change:
    old = F.col("datetime_local") < as_of - F.expr("INTERVAL 7 DAYS")
    return delete(snapshot, (F.col("magnitude") < 4.2) & (F.col("hazard_score") < 9) & old)


def delete_invalid(snapshot: DataFrame) -> Change:
    return delete(snapshot, invalid_record())


def refresh_risk_zones(clusters: DataFrame) -> Change:
    return update(clusters, F.lit(True), {"risk_zone": cluster_risk(F.col("max_magnitude"))})


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def describe_columns(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type) in table order."""
    rows = [(i + 1, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")
