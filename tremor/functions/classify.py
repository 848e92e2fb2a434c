"""Box and bin classifications, all as CASE expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tremor import constants as K


def in_box(lon: Column, lat: Column, west, east, south, north) -> Column:
    return lon.between(west, east) & lat.between(south, north)


def _first_box(lon: Column, lat: Column, boxes, default) -> Column:
    chain = F
    for value, west, east, south, north in boxes:
        chain = chain.when(in_box(lon, lat, west, east, south, north), F.lit(value))
    return chain.otherwise(F.lit(default))


def region(lon: Column, lat: Column) -> Column:
    return _first_box(lon, lat, K.REGION_BOXES, K.REGION_DEFAULT)


def geographic_zone(lon: Column, lat: Column) -> Column:
    return _first_box(lon, lat, K.ZONE_BOXES, K.ZONE_DEFAULT)


def hemisphere(lon: Column) -> Column:
    return F.when(lon < 0, "Western Hemisphere").otherwise("Eastern Hemisphere")


def tectonic_setting(lon: Column, lat: Column) -> Column:
    unknown = lon.isNull() | lat.isNull()
    return F.when(unknown, "unknown").otherwise(_first_box(lon, lat, K.TECTONIC_BOXES, K.TECTONIC_DEFAULT))


def regional_risk(lon: Column, lat: Column) -> Column:
    """0 where a coordinate is missing."""
    unknown = lon.isNull() | lat.isNull()
    scored = _first_box(lon, lat, K.REGIONAL_RISK_BOXES, K.REGIONAL_RISK_DEFAULT)
    return F.when(unknown, F.lit(0.0)).otherwise(scored)


def population_density(lon: Column, lat: Column) -> Column:
    return _first_box(lon, lat, K.POPULATION_DENSITY_BOXES, K.POPULATION_DENSITY_DEFAULT)


def _right_closed(value: Column, bins) -> Column:
    """NULL outside the outer edges; the lowest edge belongs to the first bin."""
    edges, labels = bins
    chain = F.when(value < edges[0], F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        chain = chain.when(value <= upper, label)
    return chain


def magnitude_class(magnitude: Column) -> Column:
    return _right_closed(magnitude, K.MAGNITUDE_CLASS_BINS)


def magnitude_hazard(magnitude: Column) -> Column:
    return _right_closed(magnitude, K.MAGNITUDE_HAZARD_BINS)


def depth_class(depth: Column) -> Column:
    return _right_closed(depth, K.DEPTH_CLASS_BINS)


def magnitude_level(magnitude: Column) -> Column:
    chain = F
    for upper, label in K.MAGNITUDE_LEVELS[:-1]:
        chain = chain.when(magnitude < upper, label)
    return chain.otherwise(K.MAGNITUDE_LEVELS[-1][1])


def depth_level(depth: Column) -> Column:
    chain = F
    for upper, label in K.DEPTH_LEVELS[:-1]:
        chain = chain.when(depth <= upper, label)
    return chain.otherwise(K.DEPTH_LEVELS[-1][1])


def magnitude_band(magnitude: Column) -> Column:
    return F.when(magnitude >= 7, "Major").when(magnitude >= 5, "Moderate").otherwise("Minor")


def depth_band(depth: Column) -> Column:
    return F.when(depth < 70, "Shallow").when(depth < 300, "Intermediate").otherwise("Deep")


def cluster_risk(max_magnitude: Column) -> Column:
    chain = F
    for least, zone in K.CLUSTER_RISK_STEPS:
        chain = chain.when(max_magnitude >= least, zone)
    return chain.otherwise(K.CLUSTER_RISK_DEFAULT)


def event_risk(magnitude: Column, depth: Column) -> Column:
    """Per-event rule; a missing magnitude counts as 0 and a missing depth as 999 km."""
    m, d = F.coalesce(magnitude, F.lit(0.0)), F.coalesce(depth, F.lit(999.0))
    return (
        F.when((m >= 7.0) | ((m >= 6.0) & (d < 50)), "Extreme")
        .when((m >= 5.5) | ((m >= 5.0) & (d < 70)), "High")
        .when(m >= 4.0, "Moderate")
        .otherwise("Low")
    )


def quality_flag(gap: Column, rms: Column, nst: Column) -> Column:
    """Missing indicators do not count against a record."""
    def sure(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    return F.when(sure(gap > 180) | sure(rms > 1.0) | sure(nst < 4), "Poor").otherwise("Good")
