"""Event density on a latitude/longitude grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.constants import GRID_SIZE, KM_PER_DEGREE
from tremor.operators.skew import balanced_join
from tremor.workspace import constants, materialise


def with_grid_cells(df: DataFrame, grid: float = GRID_SIZE, edge: str = "first") -> DataFrame:
    """Add ``lat_grid`` and ``lon_grid``: right-closed cells counted from the smallest coordinate.

    Events exactly on the smallest coordinate belong to cell 0, or to no cell
    with ``edge="drop"``.
    """
    if edge not in ("first", "drop"):
        raise ValueError(f"unknown edge rule {edge!r}")
    origin = constants(df.agg(F.min("latitude").alias("latitude"), F.min("longitude").alias("longitude")))

    def cell(axis: str):
        index = F.ceil((F.col(axis) - origin[axis]) / grid) - 1
        return F.when(index >= 0, index) if edge == "drop" else F.when(index.isNotNull(), F.greatest(index, F.lit(0)))

    return df.withColumns({"lat_grid": cell("latitude"), "lon_grid": cell("longitude")})


def cell_counts(df: DataFrame) -> DataFrame:
    return (
        df.filter("lat_grid is not null and lon_grid is not null")
        .groupBy("lat_grid", "lon_grid").agg(F.count(F.lit(1)).alias("grid_count"))
    )


def cell_density(count, grid: float = GRID_SIZE):
    return count / (grid * KM_PER_DEGREE) ** 2


def with_cell_counts(df: DataFrame, spread: list[str] | None = None) -> DataFrame:
    """Left join of the cell counts to the events; an event without a cell gets NULL."""
    return balanced_join(df, materialise(cell_counts(df), "cell-counts"), ["lat_grid", "lon_grid"], "left", spread or ["id"])


def with_density(df: DataFrame, grid: float = GRID_SIZE, edge: str = "first") -> DataFrame:
    """Add ``spatial_density``, events per square kilometre of the event's cell."""
    counted = with_cell_counts(with_grid_cells(df, grid, edge))
    return counted.withColumn("spatial_density", cell_density(F.col("grid_count"), grid)).drop(
        "lat_grid", "lon_grid", "grid_count"
    )


def density_table(df: DataFrame, grid: float = GRID_SIZE, edge: str = "first") -> DataFrame:
    """One row per occupied cell with its count and density."""
    return cell_counts(with_grid_cells(df, grid, edge)).withColumn("density", cell_density(F.col("grid_count"), grid))
