"""Group statistics, shares and whole-catalog summaries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.constants import HIGH_RISK, VOLUME_TARGET_MB
from tremor.operators.skew import balanced_join
from tremor.workspace import materialise


def _rows():
    return F.count(F.lit(1))


def zone_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("geographic_zone").agg(
        _rows().alias("earthquake_count"), F.avg("magnitude").alias("avg_magnitude"),
        F.stddev("magnitude").alias("std_magnitude"), F.max("magnitude").alias("max_magnitude"),
        F.min("magnitude").alias("min_magnitude"), F.avg("depth").alias("avg_depth"),
        F.avg("risk_score").alias("avg_risk_score"),
    )


def monthly_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("year", "month").agg(
        _rows().alias("monthly_count"), F.avg("magnitude").alias("monthly_avg_magnitude"),
        F.max("magnitude").alias("monthly_max_magnitude"), F.avg("risk_score").alias("monthly_avg_risk"),
    )


def category_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("magnitude_category").agg(
        _rows().alias("category_count"), F.avg("depth").alias("avg_depth_by_magnitude")
    )


def attach_zone_stats(df: DataFrame) -> DataFrame:
    """Zones are a fixed handful, so their averages are broadcast."""
    stats = zone_stats(df).select(
        "geographic_zone", F.col("avg_magnitude").alias("regional_avg_magnitude"),
        F.col("earthquake_count").alias("regional_earthquake_count"),
    )
    return df.join(F.broadcast(stats), "geographic_zone", "left")


def attach_monthly_stats(df: DataFrame) -> DataFrame:
    stats = materialise(
        monthly_stats(df).select("year", "month", F.col("monthly_avg_magnitude").alias("monthly_regional_avg_magnitude")),
        "monthly",
    )
    return balanced_join(df, stats, ["year", "month"], "left", ["id"])


def with_relative_magnitudes(df: DataFrame) -> DataFrame:
    """Magnitude against the average of the zone and of the month, both from one grouping by zone and month."""
    parts = materialise(
        df.groupBy("geographic_zone", "year", "month").agg(_rows().alias("n"), F.sum("magnitude").alias("s"), F.count("magnitude").alias("m")),
        "zone-months",
    )
    zones = parts.groupBy("geographic_zone").agg(
        F.try_divide(F.sum("s"), F.sum("m")).alias("regional_avg_magnitude"), F.sum("n").alias("regional_earthquake_count")
    )
    months = parts.groupBy("year", "month").agg(F.try_divide(F.sum("s"), F.sum("m")).alias("monthly_regional_avg_magnitude"))
    # Zones are a handful; the months are checked.
    joined = df.join(F.broadcast(zones), "geographic_zone", "left")
    joined = balanced_join(joined, materialise(months, "monthly"), ["year", "month"], "left", ["id"])
    return joined.withColumns({
        "magnitude_vs_regional_avg": F.col("magnitude") - F.col("regional_avg_magnitude"),
        "magnitude_vs_monthly_avg": F.col("magnitude") - F.col("monthly_regional_avg_magnitude"),
    })


def platform_stats(processed: DataFrame, clusters: DataFrame) -> DataFrame:
    """Totals, and one (zone, events) entry per risk zone."""
    total = processed.agg(_rows().alias("n")).scalar()
    zones = clusters.groupBy("risk_zone").agg(F.countDistinct("id").alias("count"))
    distribution = zones.agg(F.sort_array(F.collect_list(F.struct("risk_zone", "count"))).alias("d")).scalar()
    high = F.col("risk_zone").isin(*HIGH_RISK)
    return clusters.agg(
        F.countDistinct("cluster_id").alias("total_clusters"),
        F.countDistinct(F.when(high, F.col("cluster_id"))).alias("high_risk_zones"),
    ).withColumns({"total_earthquakes": total, "risk_distribution": distribution})


def estimated_mb(count):
    """Two kilobytes per record."""
    return count * 2 / 1024


def pipeline_status(processed: DataFrame, clusters: DataFrame, models: DataFrame, classifications: DataFrame) -> DataFrame:
    counts = processed.agg(_rows().alias("earthquake_records")).withColumns({
        "clusters_identified": clusters.agg(F.countDistinct("cluster_id").alias("n")).scalar(),
        "models_trained": models.agg(_rows().alias("n")).scalar(),
        "classifications_generated": classifications.agg(_rows().alias("n")).scalar(),
    })
    n, size = F.col("earthquake_records"), estimated_mb(F.col("earthquake_records"))
    advice = F.array(
        F.when(n < 1000, "collect more records"),
        F.when(F.col("clusters_identified") == 0, "run the clustering"),
        F.when(F.col("models_trained") == 0, "train the models"),
        F.when(size < VOLUME_TARGET_MB, "collect more volume"),
    )
    return counts.withColumns({
        "pipeline_status": F.when(n == 0, "error").when(n < 1000, "warning").otherwise("healthy"),
        "estimated_size_mb": F.round(size, 2),
        "meets_volume_target": size >= VOLUME_TARGET_MB,
        "clustering_completed": F.col("clusters_identified") > 0,
        "ml_ready": F.col("models_trained") > 0,
        "recommendations": F.filter(advice, lambda a: a.isNotNull()),
    })


def data_volume(df: DataFrame) -> DataFrame:
    size = estimated_mb(F.col("total_records"))
    return df.agg(
        _rows().alias("total_records"), F.countDistinct("id").alias("unique_earthquakes"),
        F.min("time").alias("earliest_record"), F.max("time").alias("latest_record"),
        F.round(F.avg("magnitude"), 2).alias("avg_magnitude"), F.countDistinct("region").alias("regions_covered"),
    ).withColumns({
        "estimated_size_mb": F.round(size, 2),
        "requirement_status": F.when(size >= VOLUME_TARGET_MB, "compliant").otherwise("non_compliant"),
    })


def catalog_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        _rows().alias("total_earthquakes"), F.avg("magnitude").alias("avg_magnitude"),
        F.max("magnitude").alias("max_magnitude"), F.countDistinct("region").alias("unique_regions"),
    )


def zone_cluster_summary(clusters: DataFrame, per_cluster: bool = False) -> DataFrame:
    """By risk zone. Over event rows, ``summed_cluster_size`` adds a cluster's size once per event;
    ``per_cluster`` counts every cluster once."""
    source = clusters
    if per_cluster:
        source = clusters.select("risk_zone", "cluster_id", "cluster_size", "avg_magnitude").distinct()
    return source.groupBy("risk_zone").agg(
        _rows().alias("row_count"), F.avg("avg_magnitude").alias("avg_magnitude"),
        F.sum("cluster_size").alias("summed_cluster_size"),
    )


def master_report(processed: DataFrame, clusters: DataFrame, zones: DataFrame, models: DataFrame) -> DataFrame:
    distribution = clusters.groupBy("risk_zone").agg(_rows().alias("n")).filter("risk_zone is not null").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("risk_zone", "n")))).alias("m")
    )
    return processed.agg(_rows().alias("total_earthquakes")).withColumns({
        "total_clusters": clusters.agg(F.countDistinct("cluster_id").alias("n")).scalar(),
        "high_risk_zones": zones.filter(F.col("risk_level").isin(*HIGH_RISK)).agg(_rows().alias("n")).scalar(),
        "models_trained": models.agg(_rows().alias("n")).scalar(),
        "risk_distribution": distribution.scalar(),
    })


def daily_stats(df: DataFrame) -> DataFrame:
    return df.filter(F.col("time").isNotNull()).groupBy(F.to_date("time").alias("date")).agg(
        F.count("magnitude").alias("earthquake_count"), F.avg("magnitude").alias("avg_magnitude"),
        F.max("magnitude").alias("max_magnitude"), F.avg("depth").alias("avg_depth"),
    )


def average_daily_count(df: DataFrame) -> DataFrame:
    return daily_stats(df).agg(F.avg("earthquake_count").alias("avg_daily"))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage of every value."""
    return with_percentage(df.groupBy(column).agg(_rows().alias("count")), "count")


def with_percentage(counted: DataFrame, count: str) -> DataFrame:
    """Share of each count in their sum. The groups are written, so that the input is read once."""
    groups = materialise(counted, "shares")
    total = groups.agg(F.sum(count).alias("n")).scalar()
    return groups.withColumn("percentage", F.col(count) * 100.0 / total)


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Long correlation matrix (x, y, r), each pair over the rows where both are present."""
    pairs = list(combinations(columns, 2))
    both = df.agg(*[F.corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    cells = [F.struct(F.lit(a).alias("x"), F.lit(a).alias("y"), F.lit(1.0).alias("r")) for a in columns]
    for i, (a, b) in enumerate(pairs):
        for x, y in ((a, b), (b, a)):
            cells.append(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"_{i}").alias("r")))
    return both.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def linear_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def approximate_medians(df: DataFrame, columns: list[str], accuracy: int = 100) -> DataFrame:
    """All medians in one pass; relative rank error is 1/accuracy. An all-NULL column gives 0."""
    return df.agg(*[
        F.coalesce(F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy), F.lit(0.0)).alias(c) for c in columns
    ])


def population_moments(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[
        e for c in columns for e in (F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std"))
    ])


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, count, mean, std, min, max) in one pass."""
    parts = df.agg(*[
        F.struct(
            F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev(c).alias("std"),
            F.min(F.col(c).cast("double")).alias("min"), F.max(F.col(c).cast("double")).alias("max"),
        ).alias(c)
        for c in columns
    ])
    return parts.select(F.explode(F.array(*columns)).alias("c")).select("c.*")


def size_estimate(df: DataFrame) -> DataFrame:
    """Bytes the rows would take as CSV, line ends included."""
    return df.agg(F.sum(F.octet_length(F.to_csv(F.struct(*df.columns))) + 1).alias("csv_bytes"))


def view_indicators(df: DataFrame) -> DataFrame:
    return df.agg(
        _rows().alias("records"), F.avg("latitude").alias("center_lat"), F.avg("longitude").alias("center_lon"),
        F.avg("magnitude").alias("avg_magnitude"), F.avg("hazard_score").alias("avg_hazard"),
        F.countDistinct("region").alias("regions"),
    )
