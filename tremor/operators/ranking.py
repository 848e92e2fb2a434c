"""Exact ranks, running totals and quantiles without putting a group in one task.

A window function sends all rows of a partition key to one task. Here rows are
range-partitioned on (group, order) into slabs, so that one large group covers
many slabs; totals of the earlier slabs are then added to per-slab results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.operators.skew import balanced_join, null_safe
from tremor.workspace import materialise


def _slab_count(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def running_total(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    weight: Column | None = None,
    name: str = "running_total",
    slabs: int | None = None,
) -> DataFrame:
    """Inclusive running sum of ``weight`` within ``keys``, in ``order``.

    With the default weight of 1 this is the row number. ``order`` must not
    have ties within a group. The carried totals table has at most one row per
    slab, because only the first group of a slab can begin in an earlier one.
    """
    weight = F.lit(1) if weight is None else weight
    layout = [F.col(c) for c in keys + order]
    laid = materialise(
        df.withColumn("_w", weight.cast("bigint"))
        .repartitionByRange(slabs or _slab_count(df), *layout)
        .withColumn("_slab", F.spark_partition_id()),
        "slabs",
    )
    per_slab = laid.groupBy("_slab", *keys).agg(F.sum("_w").alias("_slab_total"))
    earlier = Window.partitionBy(*keys).orderBy("_slab").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        per_slab.withColumn("_carried", F.sum("_slab_total").over(earlier))
        .filter(F.col("_carried") > 0)
        .select("_slab", *keys, "_carried")
    )
    within_slab = Window.partitionBy("_slab", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = laid.withColumn("_local", F.sum("_w").over(within_slab))
    joined = local.join(F.broadcast(carried), null_safe(local, carried, ["_slab", *keys]), "left")
    return joined.select(
        *[local[c] for c in df.columns], (F.col("_local") + F.coalesce("_carried", F.lit(0))).alias(name)
    )


def row_numbers(df: DataFrame, keys: list[str], order: list[str], name: str = "rn", slabs: int | None = None) -> DataFrame:
    return running_total(df, keys, order, None, name, slabs)


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, probabilities: list[float], slabs: int | None = None
) -> DataFrame:
    """Linear-interpolated quantiles per group: (keys, probability, quantile).

    NULL and NaN values are ignored. Equal values are counted before the sort,
    so neither a large group nor a frequent value lands in one task.
    """
    counted = (
        df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
        .groupBy(*keys, F.col(value).cast("double").alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    totals_key = keys or ["_all"]
    counted = counted if keys else counted.withColumn("_all", F.lit(0))
    summed = materialise(running_total(counted, totals_key, ["_value"], F.col("_n"), "_upto", slabs), "value-ranks")
    totals = materialise(summed.groupBy(*totals_key).agg(F.sum("_n").alias("_total")), "totals")
    ranked = balanced_join(summed, totals, totals_key, "inner", ["_value"], nulls_match=True)
    wanted = ranked.withColumn(
        "probability", F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    ).withColumn("_at", F.col("probability") * (F.col("_total") - 1))
    first, last = F.col("_upto") - F.col("_n"), F.col("_upto") - 1
    low, high = F.floor("_at"), F.ceil("_at")
    hits = wanted.filter((low.between(first, last)) | (high.between(first, last)))
    picked = hits.groupBy(*totals_key, "probability").agg(
        F.max(F.when(low.between(first, last), F.col("_value"))).alias("_low"),
        F.max(F.when(high.between(first, last), F.col("_value"))).alias("_high"),
        F.max(F.col("_at") - low).alias("_part"),
    )
    return picked.select(
        *keys, "probability", (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias("quantile")
    )


def column_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """Exact quantiles of several columns in one job: (column, probability, quantile)."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    ])).alias("_cell")).select("_cell.column", "_cell.value")
    return exact_quantiles(long, ["column"], "value", probabilities)


def group_quantiles_wide(df: DataFrame, keys: list[str], value: str, named: dict[str, float]) -> DataFrame:
    """One row per group with a column per named quantile."""
    long = exact_quantiles(df, keys, value, list(named.values()))
    return long.groupBy(*keys).agg(*[
        F.max(F.when(F.col("probability") == float(p), F.col("quantile"))).alias(n) for n, p in named.items()
    ])


def batches(df: DataFrame, order: list[str], size: int, name: str = "batch") -> DataFrame:
    """Fixed-size batches in ``order``, numbered from 0."""
    numbered = row_numbers(df, [], order, "_rn")
    return numbered.withColumn(name, F.floor((F.col("_rn") - 1) / size)).drop("_rn")
