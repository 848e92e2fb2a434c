"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.workspace import constants, materialise

# A side is broadcast only after its rows were counted and found within this.
BROADCAST_ROWS = 500_000
# Keys with more rows than this are split into several join keys.
ROWS_PER_SPLIT = 1_000_000
# At most so many keys are split: those with more than this fraction of the heavy rows.
HEAVY_KEYS = 10_000


def is_small(df: DataFrame, limit: int | None = None) -> bool:
    """True if ``df`` has at most ``limit`` rows. A written table is counted from its footers."""
    return df.count() <= (BROADCAST_ROWS if limit is None else limit)


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]):
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str, nulls_match: bool) -> DataFrame:
    if not nulls_match:
        return left.join(right, keys, how)
    marked = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(marked, condition, how).drop(*[f"_right_{k}" for k in keys])


def heavy_keys(left: DataFrame, keys: list[str], rows_per_split: int | None = None) -> DataFrame:
    """Keys that hold more than their share of ``left``, with the number of parts to split each into.

    A key is heavy if it has more than ``rows_per_split`` rows and more than one row in
    ``HEAVY_KEYS`` of the whole; hence there are fewer than ``HEAVY_KEYS`` of them, however
    many keys pass the first test, and the table may be broadcast.
    """
    per = ROWS_PER_SPLIT if rows_per_split is None else rows_per_split
    counted = materialise(
        left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > per), "heavy-keys"
    )
    total = constants(counted.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")))["n"]
    return counted.filter(F.col("_n") * HEAVY_KEYS > total).select(
        *keys, F.ceil(F.col("_n") / per).cast("int").alias("_splits")
    )


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    spread: list[str] | None = None,
    limit: int | None = None,
    rows_per_split: int | None = None,
    small: bool | None = None,
    nulls_match: bool = False,
) -> DataFrame:
    """Equi-join of a large, possibly skewed ``left`` with a ``right`` of few rows per key.

    ``right`` must be cheap to read twice (a written table). If it passes the
    size check it is broadcast and ``left`` is not shuffled at all. Otherwise
    every heavy key of the left (:func:`heavy_keys`) is divided: left rows get a salt from a hash of the ``spread`` columns, and the right
    rows of that key are repeated once per salt.

    ``how`` is inner, left, left_semi or left_anti; NULL keys match nothing
    unless ``nulls_match``.
    ``small`` passes on the result of an earlier :func:`is_small` check of ``right``.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    if small is None:
        small = is_small(right, limit)
    if small:
        return _join(left, F.broadcast(right), keys, how, nulls_match)
    heavy = F.broadcast(heavy_keys(left, keys, rows_per_split))
    spread = spread or [f.name for f in left.schema.fields if f.name not in keys and f.dataType.typeName() != "map"] or keys
    salted_left = _join(left, heavy, keys, "left", nulls_match).withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(*spread), F.col("_splits")), F.lit(0).cast("bigint"))
    ).drop("_splits")
    salted_right = _join(right, heavy, keys, "left", nulls_match).withColumn(
        "_salt",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("_splits").cast("bigint"), F.lit(1).cast("bigint")) - 1)),
    ).drop("_splits")
    return _join(salted_left, salted_right, keys + ["_salt"], how, nulls_match).drop("_salt")
