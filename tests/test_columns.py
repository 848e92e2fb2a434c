"""Edge values of the column functions."""

import math

import pytest
from pyspark.sql import functions as F

from tremor.functions import classify, scores, temporal, text


def values(spark, rows, schema, make):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(make().alias("x")).collect()]


def magnitudes(spark, make, *given):
    return values(spark, [(float(m),) for m in given], "m double", lambda: make(F.col("m")))


def test_right_closed_magnitudes(spark):
    assert magnitudes(spark, classify.magnitude_class, 0, 3, 3.1, 4, 5, 6, 7, 10, 10.1, -1) == [
        "Very Minor", "Very Minor", "Minor", "Minor", "Light", "Moderate", "Strong", "Major", None, None]


def test_left_closed_magnitudes(spark):
    assert magnitudes(spark, classify.magnitude_level, 0, 3, 4, 5, 6, 7, 8) == [
        "micro", "minor", "light", "moderate", "strong", "major", "great"]


def test_depth_levels(spark):
    assert magnitudes(spark, classify.depth_level, 0, 10, 30, 70, 150, 300, 500, 700) == [
        "very_shallow", "very_shallow", "shallow", "intermediate_shallow", "intermediate", "intermediate_deep", "deep", "very_deep"]
    assert magnitudes(spark, classify.depth_class, 0, 30, 70, 300, 700, 700.1) == [
        "Very Shallow", "Very Shallow", "Shallow", "Intermediate", "Deep", None]
    assert magnitudes(spark, classify.depth_band, 69.9, 70, 300) == ["Shallow", "Intermediate", "Deep"]


@pytest.mark.parametrize("lon, lat, region", [
    (106, -6, "Sumatra"), (106, -7, "Java"), (125, 0, "Sulawesi"), (108, -4.5, "Other"), (108, -4, "Kalimantan"),
    (141, -11, "Eastern_Indonesia"), (None, 0, "Other"),
])
def test_region_edges(spark, lon, lat, region):
    got = values(spark, [(None if lon is None else float(lon), float(lat))], "x double, y double", lambda: classify.region(F.col("x"), F.col("y")))
    assert got == [region]


@pytest.mark.parametrize("lon, lat, risk", [(130, -5, 0.9), (130, -10.5, 0.95), (100, 0, 0.95), (-150, 0, 0.8), (0, 0, 0.3)])
def test_regional_risk_order(spark, lon, lat, risk):
    got = values(spark, [(float(lon), float(lat))], "x double, y double", lambda: classify.regional_risk(F.col("x"), F.col("y")))
    assert got == [risk]


def test_missing_coordinates(spark):
    rows = [(None, 1.0)]
    assert values(spark, rows, "x double, y double", lambda: classify.tectonic_setting(F.col("x"), F.col("y"))) == ["unknown"]
    assert values(spark, rows, "x double, y double", lambda: classify.regional_risk(F.col("x"), F.col("y"))) == [0.0]


def test_quality_ignores_missing(spark):
    rows = [(None, None, None), (181.0, None, None), (180.0, 1.0, 4), (0.0, 1.1, 9), (0.0, 0.0, 3)]
    got = values(spark, rows, "gap double, rms double, nst int", lambda: classify.quality_flag(F.col("gap"), F.col("rms"), F.col("nst")))
    assert got == ["Good", "Poor", "Good", "Poor", "Poor"]


def test_published_risk_score(spark):
    """7.6/10 + 40/700, the first row of the published report."""
    got = values(spark, [(7.6, 40.0)], "m double, d double", lambda: F.round(scores.scaled_risk(F.col("m"), F.col("d")), 6))
    assert got == [0.817143]


def test_hazard_needs_density(spark):
    rows = [(6.0, 10.0, "Java", 0.1), (6.0, 10.0, "Java", None), (9.9, 1.0, "Java", 5.0)]
    got = values(spark, rows, "m double, d double, r string, s double",
                 lambda: scores.density_hazard(F.col("m"), F.col("d"), F.col("r"), F.col("s")))
    assert got[:2] == [8.0, None] and got[2] == 10.0


def test_intensity_composite_skips_missing(spark):
    rows = [(9.0, None, 0, "red"), (None, 9, 4000, None)]
    got = values(spark, rows, "m double, f int, s int, a string",
                 lambda: scores.intensity_composite(F.col("m"), F.col("f"), F.col("s"), F.col("a")))
    assert got == [pytest.approx(0.6), pytest.approx(0.04 + 0.2)]


def test_physics(spark):
    row = spark.createDataFrame([(6.0, 50.0, 0.0, 107.0)], "m double, d double, y double, x double").select(
        scores.seismic_moment(F.col("m")), scores.stress_drop(F.col("m"), F.col("d")),
        scores.population_exposure(F.col("y"), F.col("x"), F.col("m")), scores.log_energy(F.col("m"))).first()
    assert row[0] == pytest.approx(10 ** 18.1)
    assert row[1] == pytest.approx(15.0)
    assert row[2] == pytest.approx(100 * math.pi * 10 ** 6 / 1000)
    assert row[3] == pytest.approx(13.8)


def test_java_population(spark):
    got = values(spark, [(-7.0, 107.0, 4.0)], "y double, x double, m double", lambda: scores.population_exposure(F.col("y"), F.col("x"), F.col("m")))
    assert got == [pytest.approx(1000 * math.pi * 100 / 1000)]


def test_times(spark):
    rows = [(1_700_000_000_123,), (None,)]
    make = lambda: F.date_format(temporal.from_millis(F.col("t")), "yyyy-MM-dd HH:mm:ss.SSS")
    assert values(spark, rows, "t long", make) == ["2023-11-14 22:13:20.123", None]
    assert values(spark, rows, "t long", lambda: temporal.iso_text(temporal.from_millis(F.col("t")))) == ["2023-11-14T22:13:20Z", ""]
    local = values(spark, rows, "t long", lambda: F.hour(temporal.local_time(temporal.from_millis(F.col("t")))))
    assert local == [5, None]


def test_seasons(spark):
    rows = [(m,) for m in (12, 1, 3, 8, 11, None)]
    assert values(spark, rows, "m int", lambda: temporal.season_name(F.col("m"))) == ["winter", "winter", "spring", "summer", "autumn", None]
    assert values(spark, rows, "m int", lambda: temporal.season_number(F.col("m"))) == [1, 1, 2, 3, 4, None]


def test_text(spark):
    rows = [("5 km N. of A#b-c, D",), (None,)]
    assert values(spark, rows, "p string", lambda: text.strip_place(F.col("p"))) == ["5 km N of Ab-c, D", None]
    assert values(spark, rows, "p string", lambda: text.strip_text(F.col("p"))) == ["5 km N. of Ab-c, D", None]
    alerts = [("green",), ("RED",), ("Red",), (None,)]
    assert values(spark, alerts, "a string", lambda: text.standard_alert(F.col("a"))) == ["green", "red", "unknown", "unknown"]
    assert values(spark, alerts, "a string", lambda: text.alert_level(F.col("a"))) == [1, 0, 0, 0]


def test_event_risk_defaults(spark):
    rows = [(7.0, None), (6.0, 49.0), (6.0, 50.0), (5.0, 69.0), (5.0, 70.0), (3.9, 1.0), (None, 1.0)]
    got = values(spark, rows, "m double, d double", lambda: classify.event_risk(F.col("m"), F.col("d")))
    assert got == ["Extreme", "Extreme", "High", "High", "Moderate", "Low", "Low"]
