"""Scores, geophysical estimates and model features."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremor import constants as K
from tremor.functions.classify import population_density
from tremor.functions.text import lookup


def _square(x: Column) -> Column:
    return x * x


def at_most(x: Column, limit) -> Column:
    """Minimum that stays NULL for a NULL input (``least`` would skip it)."""
    return F.when(x.isNotNull(), F.least(x, F.lit(limit)))


def distance_from_jakarta(lat: Column, lon: Column, unit: str = "km") -> Column:
    lat0, lon0 = K.JAKARTA
    degrees = F.sqrt(_square(lat - lat0) + _square(lon - lon0))
    if unit == "degrees":
        return degrees
    if unit == "km":
        return degrees * K.KM_PER_DEGREE
    raise ValueError(f"unknown unit {unit!r}")


def ring_of_fire_distance(lat: Column, lon: Column) -> Column:
    lat0, lon0 = K.RING_OF_FIRE_POINT
    return F.sqrt(_square(lon - lon0) + _square(lat - lat0))


def ring_of_fire_axis_distance(lat: Column, lon: Column) -> Column:
    lat0, lon0 = K.RING_OF_FIRE_AXES
    return F.when(lat.isNotNull() & lon.isNotNull(), F.least(F.abs(lat - lat0), F.abs(lon - lon0)))


def magnitude_squared(m: Column) -> Column:
    return m * m


def log_energy(m: Column) -> Column:
    return 1.5 * m + 4.8


def seismic_moment(m: Column) -> Column:
    return F.pow(F.lit(10.0), 1.5 * m + 9.1)


def stress_drop(m: Column, depth: Column) -> Column:
    return F.pow(F.lit(10.0), m - 5) * (1 + depth / 100)


def intensity_composite(m: Column, felt: Column, sig: Column, alert: Column) -> Column:
    """Weighted 40/20/20/20; a missing or zero term adds nothing."""
    def term(present: Column, value: Column, weight: float) -> Column:
        used = present.isNotNull() & (present != 0)
        return F.coalesce(F.when(used, F.least(value, F.lit(1.0)) * weight), F.lit(0.0))

    return (
        term(m, m / 9.0, 0.4)
        + term(felt, F.log10(felt.cast("double") + 1) / 5.0, 0.2)
        + term(sig, sig / 2000.0, 0.2)
        + lookup(alert, K.ALERT_INTENSITY, 0.0) * 0.2
    )


def data_quality_score(gap: Column, rms: Column, nst: Column) -> Column:
    return F.greatest(
        F.lit(1.0)
        - F.when(gap > 180, 0.3).otherwise(0.0)
        - F.when(rms > 1.0, 0.2).otherwise(0.0)
        + F.when(nst >= 10, 0.1).otherwise(0.0),
        F.lit(0.0),
    )


def population_exposure(lat: Column, lon: Column, m: Column) -> Column:
    """0 where the magnitude is missing or zero, or a coordinate is missing."""
    known = m.isNotNull() & (m != 0) & lat.isNotNull() & lon.isNotNull()
    area = F.lit(math.pi) * _square(F.pow(F.lit(10.0), m - 3))
    return F.when(known, population_density(lon, lat) * area / 1000).otherwise(F.lit(0.0))


def zone_impact(m: Column, zone: Column) -> Column:
    return m * lookup(zone, K.ZONE_IMPACT, K.ZONE_IMPACT_DEFAULT)


def depth_impact(m: Column, depth: Column) -> Column:
    return m * 1000 - depth * 10


def tectonic_activity(zone: Column) -> Column:
    return lookup(zone, K.ZONE_ACTIVITY, K.ZONE_ACTIVITY_DEFAULT)


def weighted_risk(m: Column, depth: Column, alert: Column) -> Column:
    depth_part = F.when(depth <= 50, 1.0).otherwise(0.5) * 0.3
    return m * 0.4 + depth_part + lookup(alert, K.ALERT_RISK, K.ALERT_RISK_DEFAULT) * 0.3


def scaled_risk(m: Column, depth: Column) -> Column:
    return m / 10 + depth / 700


def _steps(x: Column, steps) -> Column:
    chain = F
    for least, points in steps:
        chain = chain.when(x >= least, points)
    return chain.otherwise(0)


def intensity_score(felt: Column, cdi: Column, mmi: Column) -> Column:
    return _steps(felt, K.FELT_STEPS) + _steps(cdi, K.INTENSITY_STEPS) + _steps(mmi, K.INTENSITY_STEPS)


def density_hazard(m: Column, depth: Column, region: Column, density: Column) -> Column:
    """0 to 10; NULL when magnitude or density is NULL."""
    shallow = F.when(depth <= 30, 2).when(depth <= 70, 1).otherwise(0)
    total = at_most(m / 2, 4.0) + shallow + lookup(region, K.REGION_HAZARD, None) + at_most(density * 10, 2.0)
    return at_most(total, 10.0)


def impact_hazard(m: Column, intensity: Column, alert_level: Column, tsunami: Column, depth: Column) -> Column:
    return (
        F.coalesce(m, F.lit(0.0)) * 2 + intensity * 1.5 + alert_level + tsunami * 3
        + F.when(depth <= 30, 2).otherwise(0)
    )


def magnitude_depth_ratio(m: Column, depth: Column) -> Column:
    """NULL at depth -1, where the ratio is undefined."""
    return F.try_divide(m, depth + 1)


def shallow_flag(depth: Column) -> Column:
    return F.when(depth < 70, 1).otherwise(0)


def coarse_cell(lat: Column, lon: Column) -> Column:
    return (lat * 100 + lon).cast("int")


def surface_distance(depth: Column) -> Column:
    return F.coalesce(depth, F.lit(0.0))


BASIC_FEATURES = (
    "latitude", "longitude", "magnitude", "depth", "spatial_density", "hazard_score",
    "distance_from_jakarta", "magnitude_depth_ratio", "shallow_earthquake",
)
EXTENDED_FEATURES = (
    "latitude", "longitude", "magnitude", "depth", "spatial_density", "hazard_score",
    "distance_from_jakarta", "distance_from_ring_of_fire", "magnitude_depth_ratio", "energy_density",
    "shallow_earthquake", "high_magnitude", "lat_lon_interaction", "hazard_spatial_interaction",
)


def with_basic_features(df: DataFrame) -> DataFrame:
    lat, lon, m, d = (F.col(c) for c in ("latitude", "longitude", "magnitude", "depth"))
    return df.withColumns({
        "distance_from_jakarta": distance_from_jakarta(lat, lon, "degrees"),
        "magnitude_depth_ratio": magnitude_depth_ratio(m, d),
        "shallow_earthquake": shallow_flag(d),
    })


def with_extended_features(df: DataFrame) -> DataFrame:
    lat, lon, m = F.col("latitude"), F.col("longitude"), F.col("magnitude")
    density, hazard = F.col("spatial_density"), F.col("hazard_score")
    return with_basic_features(df).withColumns({
        "distance_from_ring_of_fire": ring_of_fire_axis_distance(lat, lon),
        "energy_density": density * magnitude_squared(m),
        "high_magnitude": F.when(m > 5.0, 1).otherwise(0),
        "lat_lon_interaction": lat * lon,
        "hazard_spatial_interaction": hazard * density,
    })
