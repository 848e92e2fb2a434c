"""Evaluation profile and its six named reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.functions import classify, scores
from tremor.operators.stats import with_percentage
from tremor.operators.validate import suite_summary, with_fallback
from tremor.workspace import materialise


def derive(catalog: DataFrame) -> DataFrame:
    lat, lon, m, d = (F.col(c) for c in ("latitude", "longitude", "magnitude", "depth"))
    return catalog.select("id", "time", "latitude", "longitude", "depth", "magnitude", "place").withColumns({
        "processed_at": F.current_timestamp(),
        "year": F.year("time"), "month": F.month("time"),
        "magnitude_category": classify.magnitude_band(m),
        "geographic_zone": classify.hemisphere(lon),
        "risk_score": scores.scaled_risk(m, d),
        "depth_category_detailed": classify.depth_band(d),
        "population_impact_estimate": scores.depth_impact(m, d),
        "earthquake_cluster": scores.coarse_cell(lat, lon),
    })


def _mean(column: str, digits: int, name: str):
    return F.round(F.avg(column), digits).alias(name)


def top_magnitude(df: DataFrame, limit: int = 10) -> DataFrame:
    return df.filter("magnitude is not null").orderBy(F.desc("magnitude"), "id").limit(limit).select(
        "id", "magnitude", "place", "latitude", "longitude", "depth", "geographic_zone", "risk_score"
    )


def by_zone(df: DataFrame) -> DataFrame:
    return df.filter("geographic_zone is not null").groupBy("geographic_zone").agg(
        F.count(F.lit(1)).alias("earthquake_count"), _mean("magnitude", 2, "avg_magnitude"),
        F.round(F.max("magnitude"), 2).alias("max_magnitude"), _mean("risk_score", 3, "avg_risk_score"),
    ).orderBy(F.desc("earthquake_count"), "geographic_zone")


def monthly_trends(df: DataFrame) -> DataFrame:
    return df.filter("year is not null and month is not null").groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("monthly_count"), _mean("magnitude", 2, "avg_magnitude"),
        F.count_if(F.col("magnitude") >= 5.0).alias("major_earthquakes"),
    ).orderBy("year", "month")


def depth_analysis(df: DataFrame) -> DataFrame:
    return df.filter("depth_category_detailed is not null").groupBy("depth_category_detailed").agg(
        F.count(F.lit(1)).alias("count"), _mean("magnitude", 2, "avg_magnitude"), _mean("depth", 1, "avg_depth"),
        _mean("risk_score", 3, "avg_risk_score"),
    ).orderBy("avg_depth")


def high_risk(df: DataFrame, threshold: float = 0.7) -> DataFrame:
    return df.filter(F.col("risk_score") > threshold).groupBy("geographic_zone", "magnitude_category").agg(
        F.count(F.lit(1)).alias("count"), _mean("risk_score", 3, "avg_risk_score"),
        _mean("population_impact_estimate", 0, "avg_population_impact"),
    ).orderBy(F.desc("avg_risk_score"), "geographic_zone", "magnitude_category")


def cell_analysis(df: DataFrame, digits: tuple[int, int, int] = (2, 1, 3)) -> DataFrame:
    """Per coarse cell and zone, with the share of all events. ``digits`` rounds magnitude, depth and risk.

    The cells are at most as many as the globe has; their counts add up to the total.
    """
    cells = df.groupBy(
        F.coalesce("earthquake_cluster", F.lit(-1)).alias("earthquake_cluster"), "geographic_zone"
    ).agg(
        F.count(F.lit(1)).alias("cluster_size"), _mean("magnitude", digits[0], "avg_magnitude"),
        _mean("depth", digits[1], "avg_depth"), _mean("risk_score", digits[2], "avg_risk"),
    )
    return with_percentage(cells, "cluster_size")


def report_makers(df: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    """All six, to be made one by one."""
    return {
        "top_magnitude_earthquakes": lambda: top_magnitude(df),
        "earthquakes_by_zone": lambda: by_zone(df),
        "monthly_trends": lambda: monthly_trends(df),
        "depth_analysis": lambda: depth_analysis(df),
        "high_risk_analysis": lambda: high_risk(df),
        "clustering_analysis": lambda: cell_analysis(df),
    }


def fallbacks() -> dict[str, dict[str, Column]]:
    """The row two of the reports show when they would be empty."""
    now = F.current_date()
    return {
        "monthly_trends": {"year": F.year(now), "month": F.month(now), "monthly_count": F.lit(0), "major_earthquakes": F.lit(0)},
        "clustering_analysis": {"earthquake_cluster": F.lit(0), "cluster_size": F.lit(0), "percentage": F.lit(0.0)},
    }


def reports(df: DataFrame) -> dict[str, DataFrame]:
    empty = fallbacks()
    made = {name: make() for name, make in report_makers(df).items()}
    return {name: with_fallback(materialise(r, "report"), empty[name]) if name in empty else r for name, r in made.items()}


def summary(df: DataFrame, path: str | None = None) -> DataFrame:
    """(query, status, row_count, error) of the reports, each written once to ``path/<report>``; one that fails does not stop the others."""
    return suite_summary(df.sparkSession, report_makers(df), path, fallbacks())
