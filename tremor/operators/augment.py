"""Noisy copies of a catalog, for volume tests."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor.workspace import constants

NOISY = ("longitude", "latitude", "depth", "magnitude")


def _uniform(*parts) -> Column:
    """A number in (0, 1] that depends only on its inputs: 52 bits of their MD5."""
    digits = F.substring(F.md5(F.concat_ws("/", *[p.cast("string") for p in parts])), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint") + 1) / float(1 << 52)


def _normal(seed: int, *parts) -> Column:
    """Standard normal by the Box-Muller transform; the same again if a task is repeated."""
    u, v = _uniform(*parts, F.lit(2 * seed)), _uniform(*parts, F.lit(2 * seed + 1))
    return F.sqrt(-2 * F.ln(u)) * F.cos(2 * math.pi * v)


def copies_for_size(current_mb: float, target_mb: float, most: int | None = None) -> int:
    """Copies, the original included, that reach the target size."""
    needed = max(1, math.ceil(target_mb / current_mb))
    return needed if most is None else min(needed, most)


def augment(
    df: DataFrame, copies: int, seed: int = 42, suffix: str = "_aug_", scale: float = 0.001, label: str | None = None
) -> DataFrame:
    """The catalog and ``copies - 1`` copies with normal noise of ``scale`` standard deviations.

    ``label`` becomes the ``data_source`` of the copies.
    """
    spread = constants(df.agg(*[F.stddev(c).alias(c) for c in NOISY]))
    repeated = df.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    copied = F.col("_copy") > 0
    changes = {
        c: F.when(
            copied, F.col(c) + _normal(seed, F.col("id"), F.col("_copy"), F.lit(c)) * spread[c] * scale
        ).otherwise(F.col(c))
        for c in NOISY
    }
    changes["id"] = F.when(copied, F.concat("id", F.lit(suffix), F.col("_copy").cast("string"))).otherwise(F.col("id"))
    if label is not None:
        before = F.col("data_source") if "data_source" in df.columns else F.lit(None).cast("string")
        changes["data_source"] = F.when(copied, F.lit(label)).otherwise(before)
    return repeated.withColumns(changes).drop("_copy")
