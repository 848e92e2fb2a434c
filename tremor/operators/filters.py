"""Row filters and schema alignment."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.functions.classify import quality_flag
from tremor.operators.ranking import exact_quantiles
from tremor.workspace import constants


def coordinates_valid() -> Column:
    return F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180)


def _is_number(name: str) -> Column:
    """NaN compares greater than every number, so it must be excluded by name."""
    return F.col(name).isNotNull() & ~F.isnan(name)


def valid_events(df: DataFrame) -> DataFrame:
    """Events with an id, coordinates on the globe, positive magnitude and depth at or below ground."""
    return df.filter(
        coordinates_valid() & (F.col("magnitude") > 0) & _is_number("magnitude")
        & (F.col("depth") >= 0) & _is_number("depth") & F.col("id").isNotNull()
    )


def valid_stream_events(df: DataFrame) -> DataFrame:
    """As :func:`valid_events`, but depth may be anything."""
    return df.filter(_is_number("magnitude") & (F.col("magnitude") > 0) & coordinates_valid())


def in_bounds(west: float, east: float, south: float, north: float) -> Column:
    """Bounding box; ``west`` beyond ``east`` means the box crosses the 180th meridian."""
    lon = F.col("longitude")
    across = (lon >= west) | (lon <= east) if west > east else lon.between(west, east)
    return across & F.col("latitude").between(south, north)


def select_catalog(
    df: DataFrame,
    start: str | None = None,
    end: str | None = None,
    min_magnitude: float | None = None,
    bounds: tuple[float, float, float, float] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Time range, least magnitude and box; ``limit`` keeps the newest rows as a catalog service does."""
    if start is not None:
        df = df.filter(F.col("time") >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.filter(F.col("time") <= F.lit(end).cast("timestamp"))
    if min_magnitude is not None:
        df = df.filter(F.col("magnitude") >= min_magnitude)
    if bounds is not None:
        df = df.filter(in_bounds(*bounds))
    return df if limit is None else df.orderBy(F.desc("time"), "id").limit(limit)


def select_columns(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def interactive_filter(
    df: DataFrame, min_magnitude: float, risk_zones: list[str] | None = None, regions: list[str] | None = None
) -> DataFrame:
    """An empty list does not filter."""
    df = df.filter(F.col("magnitude") >= min_magnitude)
    if risk_zones:
        df = df.filter(F.col("risk_zone").isin(risk_zones))
    if regions:
        df = df.filter(F.col("region").isin(regions))
    return df


def optional_filters(df: DataFrame, *conditions: tuple[object, Column]) -> DataFrame:
    """Apply each (argument, condition) whose argument was given."""
    for argument, condition in conditions:
        if argument is not None:
            df = df.filter(condition)
    return df


def with_quality(df: DataFrame) -> DataFrame:
    return df.withColumn("data_quality", quality_flag(F.col("gap"), F.col("rms"), F.col("nst")))


def good_quality(df: DataFrame) -> DataFrame:
    return with_quality(df).filter("data_quality = 'Good'")


def within_quartile_fences(df: DataFrame, column: str = "magnitude", reach: float = 1.5) -> DataFrame:
    """Keep values within ``reach`` interquartile ranges of the quartiles."""
    quartiles = exact_quantiles(df, [], column, [0.25, 0.75])
    fences = constants(quartiles.agg(F.min("quantile").alias("q1"), F.max("quantile").alias("q3")))
    width = fences["q3"] - fences["q1"]
    return df.filter(F.col(column).between(fences["q1"] - reach * width, fences["q3"] + reach * width))


def invalid_record() -> Column:
    """True, false or NULL by SQL logic; a record is invalid only if this is true."""
    def outside(name: str, low: float, high: float) -> Column:
        return (F.col(name) < low) | (F.col(name) > high)

    def empty(name: str) -> Column:
        return F.col(name).isNull() | (F.col(name) == "")

    return (
        outside("latitude", -90, 90) | outside("longitude", -180, 180) | outside("magnitude", 0, 10)
        | outside("depth", 0, 800) | outside("hazard_score", 0, 50) | outside("intensity_score", 0, 30)
        | empty("region") | empty("place")
    )


def latest(df: DataFrame, condition: Column, limit: int = 5, time: str = "datetime_local") -> DataFrame:
    """The newest rows that meet a condition."""
    return df.filter(condition).orderBy(F.desc(time), "id").limit(limit)


def shallowest(df: DataFrame, condition: Column, limit: int = 10) -> DataFrame:
    """The first rows by depth that meet a condition."""
    return df.filter(condition).orderBy("depth", "id").limit(limit)


def labelled(df: DataFrame) -> DataFrame:
    return df.filter(F.col("risk_zone").isNotNull() & (F.col("risk_zone") != "Unknown"))


def without_noise(df: DataFrame) -> DataFrame:
    return df.filter(F.col("cluster_id") != -1)


def with_provenance(df: DataFrame, source: str, stage: str, year: Column) -> DataFrame:
    return df.withColumns({
        "data_source": F.lit(source), "processing_stage": F.lit(stage), "year": year,
        "extraction_timestamp": F.current_timestamp(),
    })


def normalise_schema(df: DataFrame, schema: T.StructType, defaults: dict[str, Column] | None = None) -> DataFrame:
    """Exactly the columns of ``schema``; absent ones become their default, or a typed NULL."""
    defaults = defaults or {}
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else defaults.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def require_columns(df: DataFrame, needed: Iterable[str]) -> DataFrame:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
