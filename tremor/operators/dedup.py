"""Deduplication and set operations.

``row_number() = 1`` is safe on a key with very many rows: Spark prunes each map
task to one row per key before the shuffle. Numbers beyond the first need the
slab-wise ranking.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremor.operators.digests import narrowed_join
from tremor.operators.ranking import row_numbers


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: list[str], newest_by: list[str]) -> DataFrame:
    """The newest version per key; ``newest_by`` must settle every tie."""
    return first_per_key(df, keys, [F.desc_nulls_last(c) for c in newest_by])


def duplicates(df: DataFrame, content: list[str], id_col: str = "id") -> DataFrame:
    """Rows whose content occurs under a smaller id, with their number ``rn`` (2 and up)."""
    return row_numbers(df, content, [id_col]).filter("rn > 1")


def without_duplicates(df: DataFrame, content: list[str], id_col: str = "id") -> DataFrame:
    return first_per_key(df, content, [F.asc(id_col)])


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def except_distinct(df: DataFrame, other: DataFrame) -> DataFrame:
    return df.subtract(other)


def new_since(df: DataFrame, snapshot: DataFrame, key: str = "id", **options) -> DataFrame:
    """Rows whose key is not in the snapshot. Both are read several times, see :func:`narrowed_join`."""
    return narrowed_join(df, snapshot, [key], "left_anti", **options)


def missing_parents(children: DataFrame, parents: DataFrame, key: str, parent_key: str = "id", **options) -> DataFrame:
    """Rows whose non-NULL reference has no parent. Both are read several times, see :func:`narrowed_join`."""
    known = parents.select(F.col(parent_key).alias(key))
    return narrowed_join(children.filter(F.col(key).isNotNull()), known, [key], "left_anti", **options)
