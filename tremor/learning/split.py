"""Exact stratified splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremor.operators.skew import balanced_join
from tremor.workspace import materialise

# Hash values are counted in this many ranges per class.
RANGES = 1 << 16


def _hashed(df: DataFrame, id_col: str, seed: int) -> DataFrame:
    """A pseudo-random non-negative number per row, and its leading 16 of 63 bits."""
    draw = F.xxhash64(id_col, F.lit(seed)).bitwiseAND(F.lit((1 << 63) - 1))
    return df.withColumn("_draw", draw).withColumn("_range", F.shiftright("_draw", 47))


def with_class_position(df: DataFrame, label: str, id_col: str = "id", seed: int = 42) -> DataFrame:
    """Add ``position`` (from 0, in a random order within the class) and ``class_size``.

    A class can hold most of the rows, so classes are not sorted as a whole. Rows
    are counted per class and hash range, the counts give each range its first
    position, and only rows of one range are ranked against each other.
    """
    hashed = _hashed(df, id_col, seed)
    counts = hashed.groupBy(label, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(label).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(
        counts.withColumns({
            "_first": F.coalesce(F.sum("_n").over(before), F.lit(0)),
            "class_size": F.sum("_n").over(Window.partitionBy(label)),
        }).drop("_n"),
        "class-ranges",
    )
    placed = balanced_join(hashed, starts, [label, "_range"], "inner", [id_col])
    in_range = Window.partitionBy(label, "_range").orderBy("_draw", id_col)
    return placed.withColumn("position", F.col("_first") + F.row_number().over(in_range) - 1).drop(
        "_draw", "_range", "_first"
    )


def stratified_split(
    df: DataFrame, label: str, test_share: float = 0.2, id_col: str = "id", seed: int = 42
) -> DataFrame:
    """Add ``is_test``: of every class, exactly the rounded share of its rows."""
    placed = with_class_position(df, label, id_col, seed)
    return placed.withColumn("is_test", F.col("position") < F.round(F.col("class_size") * test_share)).drop(
        "position", "class_size"
    )


def stratified_folds(df: DataFrame, label: str, folds: int = 5, id_col: str = "id", seed: int = 42) -> DataFrame:
    """Add ``fold``; class counts of two folds differ by at most one."""
    placed = with_class_position(df, label, id_col, seed)
    return placed.withColumn("fold", (F.col("position") % folds).cast("int")).drop("position", "class_size")
