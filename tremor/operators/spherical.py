"""Great-circle geometry on the unit sphere, as column expressions and joins.

Points are placed in cubes of a grid over the unit sphere, so neither the poles
nor the 180th meridian need special care.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AXES = ["ux", "uy", "uz"]
# A cube's key packs three coordinates of 21 bits each, shifted to be positive.
BITS = 21
SHIFT = 1 << (BITS - 1)
SMALLEST_EPS = 2e-6


def chord(eps: float) -> float:
    """Straight-line length on the unit sphere for an angle of ``eps`` radians."""
    return 2.0 * math.sin(min(eps, math.pi) / 2.0)


def cell_side(eps: float) -> float:
    """Cube side at which two points of one cube are always within ``eps``."""
    return chord(eps) / math.sqrt(3.0)


def place_on_sphere(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Add radians ``phi`` and ``lam`` and the unit vector ``ux, uy, uz``."""
    phi, lam = F.radians(lat), F.radians(lon)
    return df.withColumns({"phi": phi, "lam": lam}).withColumns({
        "ux": F.cos("phi") * F.cos("lam"), "uy": F.cos("phi") * F.sin("lam"), "uz": F.sin("phi"),
    })


def cell_key(side: float) -> Column:
    """Key of the cube that holds the unit vector."""
    x, y, z = [F.floor(F.col(axis) / side) + SHIFT for axis in AXES]
    return F.shiftleft(x, 2 * BITS) + F.shiftleft(y, BITS) + z


def _unpacked(key: Column) -> list[Column]:
    mask = (1 << BITS) - 1
    return [F.shiftright(key, n * BITS).bitwiseAND(F.lit(mask)) - SHIFT for n in (2, 1, 0)]


def block_key(cell: Column, side: float, parts: int) -> Column:
    """Key of one of ``parts`` cubed equal blocks within a cube."""
    key = F.lit(0).cast("bigint")
    for axis, corner in zip(AXES, _unpacked(cell)):
        step = F.floor((F.col(axis) - corner * side) * (parts / side))
        key = key * parts + F.greatest(F.lit(0), F.least(step, F.lit(parts - 1)))
    return key


def half_haversine(phi1: Column, lam1: Column, phi2: Column, lam2: Column) -> Column:
    """Squared sine of half the angle between two points."""
    a, b = F.sin((phi2 - phi1) / 2), F.sin((lam2 - lam1) / 2)
    return a * a + F.cos(phi1) * F.cos(phi2) * b * b


def angle(phi1: Column, lam1: Column, phi2: Column, lam2: Column) -> Column:
    """Great-circle angle in radians."""
    return 2 * F.asin(F.least(F.lit(1.0), F.sqrt(half_haversine(phi1, lam1, phi2, lam2))))


def is_within(eps: float, phi1: Column, lam1: Column, phi2: Column, lam2: Column) -> Column:
    """True if the angle is at most ``eps``; compares squared half-sines, without asin."""
    limit = math.sin(min(eps, math.pi) / 2.0) ** 2
    return half_haversine(phi1, lam1, phi2, lam2) <= limit


def box_aggregates() -> list[Column]:
    """Bounding box of a group's unit vectors."""
    return [f(axis).alias(f"{p}{axis[1]}") for axis in AXES for p, f in (("lo_", F.min), ("hi_", F.max))]


def box_gap_squared(a: str, b: str) -> Column:
    """Squared distance of two boxes, given as column prefixes such as ``a_``."""
    total = None
    for d in "xyz":
        gap = F.greatest(
            F.col(f"{b}lo_{d}") - F.col(f"{a}hi_{d}"), F.col(f"{a}lo_{d}") - F.col(f"{b}hi_{d}"), F.lit(0.0)
        )
        total = gap * gap if total is None else total + gap * gap
    return total


def box_reach_squared(a: str, b: str) -> Column:
    """Squared largest distance between a point of one box and a point of the other."""
    total = None
    for d in "xyz":
        reach = F.greatest(
            F.col(f"{b}hi_{d}") - F.col(f"{a}lo_{d}"), F.col(f"{a}hi_{d}") - F.col(f"{b}lo_{d}")
        )
        total = reach * reach if total is None else total + reach * reach
    return total


def neighbour_offsets() -> list[tuple[int, int, int]]:
    """Offsets of other cubes that can hold a point within ``eps`` when the side is :func:`cell_side`.

    Two cubes two apart on every axis are always farther than the cube diagonal.
    """
    span = range(-2, 3)
    return [(x, y, z) for x in span for y in span for z in span if 0 < abs(x) + abs(y) + abs(z) < 6]


def with_neighbour_cells(cells: DataFrame, side: float, cell: str, name: str) -> DataFrame:
    """Repeat each row for every neighbouring cube that the sphere passes through."""
    steps = F.array(*[F.lit((x << 2 * BITS) + (y << BITS) + z).cast("bigint") for x, y, z in neighbour_offsets()])
    moved = cells.withColumn("_step", F.explode(steps)).withColumn(name, F.col(cell) + F.col("_step")).drop("_step")
    # A cube meets the sphere only if its centre is within half a diagonal of radius 1.
    centre = [(c + 0.5) * side for c in _unpacked(F.col(name))]
    radius = F.sqrt(sum((c * c for c in centre[1:]), centre[0] * centre[0]))
    return moved.filter(F.abs(radius - 1.0) <= side * math.sqrt(3.0) / 2 * 1.000001 + 1e-12)
