"""Data-quality rules, all evaluated in one pass over the data."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.operators.dedup import missing_parents
from tremor.sources.sinks import write_counted, write_parquet
from tremor.workspace import new_path

# Queries of a suite that run at the same time.
PARALLEL_QUERIES = 4


class ValidationError(ValueError):
    """Raised in strict mode when a rule fails."""


@dataclass(frozen=True)
class Rule:
    """``failed`` counts offending rows; the rule passes if their share is at most 1 - ``mostly``."""

    kind: str
    column: str
    offends: Column | None = None
    mostly: float = 1.0
    low: int | None = None
    high: int | None = None


def row_count(low: int, high: int | None = None) -> Rule:
    """At least ``low`` rows, and at most ``high`` if one is given."""
    return Rule("row_count", "*", low=low, high=high)


def not_null(column: str, mostly: float = 1.0) -> Rule:
    return Rule("not_null", column, F.col(column).isNull(), mostly)


def between(column: str, low: float, high: float) -> Rule:
    """NULL values are ignored."""
    return Rule("between", column, ~F.col(column).between(low, high))


def in_set(column: str, values: list[str]) -> Rule:
    """NULL values are ignored."""
    return Rule("in_set", column, ~F.col(column).isin(values))


def raw_rules(max_rows: int | None = None) -> list[Rule]:
    """Rules for a freshly landed catalog."""
    return [
        row_count(1000, max_rows), not_null("id"), not_null("magnitude"), between("magnitude", 0.0, 10.0),
        between("latitude", -12.0, 8.0), between("longitude", 94.0, 142.0), between("depth", 0.0, 800.0),
    ]


def spark_raw_rules(max_rows: int | None = None) -> list[Rule]:
    """The shorter suite of the batch ingestion."""
    return [
        row_count(1000, max_rows), not_null("id"), between("magnitude", 0.0, 10.0),
        between("latitude", -12.0, 8.0), between("longitude", 94.0, 142.0),
    ]


def processed_rules(max_rows: int | None = None) -> list[Rule]:
    """Rules for the processed table."""
    return [
        row_count(1000, max_rows), not_null("id"), not_null("magnitude"), not_null("latitude"), not_null("longitude"),
        between("magnitude", 0.5, 10.0), between("latitude", -12.0, 8.0), between("longitude", 94.0, 142.0),
        between("depth", 0.0, 800.0), between("hazard_score", 0.0, 10.0), between("spatial_density", 0.0, 100.0),
        in_set("region", ["Java", "Sumatra", "Sulawesi", "Eastern_Indonesia", "Kalimantan", "Other"]),
        in_set("magnitude_category", ["Very Minor", "Minor", "Light", "Moderate", "Strong", "Major"]),
        in_set("depth_category", ["Very Shallow", "Shallow", "Intermediate", "Deep"]),
        not_null("time", mostly=0.95),
    ]


def check(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule, kind, column, failed, total, passed), one row per rule, from a single aggregation."""
    total = F.count(F.lit(1)).alias("total")
    counts = [F.count_if(r.offends).alias(f"_{i}") for i, r in enumerate(rules) if r.offends is not None]
    measured = df.agg(total, *counts)
    cells = []
    for i, rule in enumerate(rules):
        if rule.offends is None:
            passed = F.col("total") >= rule.low
            if rule.high is not None:
                passed = passed & (F.col("total") <= rule.high)
            failed = F.when(passed, F.lit(0)).otherwise(F.lit(1)).cast("bigint")
        else:
            failed = F.col(f"_{i}")
            passed = failed <= F.col("total") * (1 - rule.mostly) + 1e-9
        cells.append(F.struct(
            F.lit(i).alias("rule"), F.lit(rule.kind).alias("kind"), F.lit(rule.column).alias("column"),
            failed.alias("failed"), F.col("total"), passed.alias("passed"),
        ))
    return measured.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def report(results: DataFrame, strict: bool = False) -> DataFrame:
    """One row with totals and score. Strict mode raises if a rule failed."""
    summary = results.agg(
        F.count(F.lit(1)).alias("total_expectations"), F.count_if("passed").alias("successful_expectations"),
        F.count_if(~F.col("passed")).alias("failed_expectations"), F.every("passed").alias("success"),
        F.avg(F.col("passed").cast("double")).alias("data_quality_score"),
    )
    if strict:
        broken = results.filter(~F.col("passed")).select("kind", "column").collect()
        if broken:
            raise ValidationError("; ".join(f"{r.kind} on {r.column}" for r in broken))
    return summary


FIELD_FAULTS = {
    "magnitude": lambda: F.col("magnitude").isNull(),
    "latitude": lambda: F.col("latitude").isNull() | ~F.col("latitude").between(-90, 90),
    "longitude": lambda: F.col("longitude").isNull() | ~F.col("longitude").between(-180, 180),
    "depth": lambda: F.col("depth").isNull() | (F.col("depth") < 0),
}


def _share(part: Column, whole: Column) -> Column:
    return F.try_divide(part * 100.0, whole)


def _field_share(field: str) -> Column:
    return F.coalesce(_share(F.col(f"bad_{field}"), F.col("n")), F.lit(0.0))


def _pass(condition: Column) -> Column:
    return F.when(condition, "PASS").otherwise("FAIL")


def _field_counts() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *[F.count_if(bad()).alias(f"bad_{f}") for f, bad in FIELD_FAULTS.items()]]


IN_RANGE = "magnitude between 2.5 and 9.5"


def field_quality(df: DataFrame) -> DataFrame:
    """Share of missing or impossible values per field; under 5 percent passes."""
    cells = [
        F.struct(F.lit(f).alias("field"), F.col(f"bad_{f}").alias("null_count"), _field_share(f).alias("null_percentage")) for f in FIELD_FAULTS
    ]
    exploded = df.agg(*_field_counts()).select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    return exploded.withColumn("status", _pass(F.col("null_percentage") < 5))


def magnitude_range(df: DataFrame) -> DataFrame:
    counted = df.agg(
        F.min("magnitude").alias("min_magnitude"), F.max("magnitude").alias("max_magnitude"),
        F.avg("magnitude").alias("avg_magnitude"), F.count_if(F.expr(IN_RANGE)).alias("valid"), F.count(F.lit(1)).alias("n"),
    )
    share = _share(F.col("valid"), F.col("n"))
    return counted.select(
        "min_magnitude", "max_magnitude", "avg_magnitude", share.alias("valid_range_percentage"), _pass(share > 95).alias("status"),
    )


def zone_distribution(df: DataFrame) -> DataFrame:
    """Per zone, with the status of the whole check on every row; without any zone one FAIL row."""
    zones = df.filter("geographic_zone is not null").groupBy("geographic_zone").agg(
        F.count(F.lit(1)).alias("zone_count"), F.avg("magnitude").alias("avg_magnitude")
    )
    gathered = zones.agg(F.collect_list(F.struct("*")).alias("zones"))  # as many as there are zones: a handful
    none = F.array(F.struct(F.lit(None).cast("string").alias("geographic_zone"), F.lit(0).cast("bigint").alias("zone_count"), F.lit(None).cast("double").alias("avg_magnitude")))
    empty = F.size("zones") == 0
    return gathered.select(F.explode(F.when(empty, none).otherwise(F.col("zones"))).alias("z"), _pass(~empty).alias("status")).select("z.*", "status")


def temporal_coverage(df: DataFrame) -> DataFrame:
    return df.filter("year is not null").agg(
        F.min("year").alias("min_year"), F.max("year").alias("max_year"),
        (F.max("year") - F.min("year")).alias("year_span"),
        F.countDistinct("year").alias("unique_years"), F.countDistinct("month").alias("unique_months"),
    ).withColumn("status", _pass(F.col("unique_years") > 1))


def overall_status(df: DataFrame) -> DataFrame:
    """(test, status) for each test of the evaluation job and an ``overall`` row, all from one aggregation."""
    counted = df.agg(
        *_field_counts(), F.count_if(F.expr(IN_RANGE)).alias("in_range"), F.count("geographic_zone").alias("zoned"),
        F.min("year").alias("first_year"), F.max("year").alias("last_year"),
    )
    tests = {
        "record_count": F.col("n") > 0,
        **{f"{f}_quality": _field_share(f) < 5 for f in FIELD_FAULTS},
        "magnitude_range": _share(F.col("in_range"), F.col("n")) > 95,
        "geographic_distribution": F.col("zoned") > 0,
        "temporal_coverage": F.col("last_year") > F.col("first_year"),
    }
    passed = {name: F.coalesce(ok, F.lit(False)) for name, ok in tests.items()}
    everything = F.lit(True)
    for ok in passed.values():
        everything = everything & ok
    cells = [F.struct(F.lit(name).alias("test"), _pass(ok).alias("status")) for name, ok in {**passed, "overall": everything}.items()]
    return counted.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def key_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def reference_violations(children: DataFrame, parents: DataFrame, key: str, parent_key: str = "id") -> DataFrame:
    """(violations, checked) of a foreign key."""
    checked = children.agg(F.count(key).alias("n")).scalar()
    return missing_parents(children, parents, key, parent_key).agg(
        F.count(F.lit(1)).alias("violations")
    ).withColumn("checked", checked)


def landed_file_check(df: DataFrame, size_mb: float) -> DataFrame:
    """Checks before processing: required columns, more than 100 rows; a small size only warns."""
    for column in ("magnitude", "latitude", "longitude"):
        if column not in df.columns:
            raise ValidationError(f"missing column {column}")
    return df.agg(
        F.count(F.lit(1)).alias("records"), F.min("year").alias("first_year"), F.max("year").alias("last_year"),
        F.countDistinct("region").alias("regions"),
    ).withColumns({
        "enough_records": F.col("records") > 100,
        "size_status": F.lit("ok" if size_mb >= 64 else "below target"),
    })


def with_fallback(df: DataFrame, fallback: dict[str, Column]) -> DataFrame:
    """The rows of ``df``, or one fallback row if there are none. ``df`` is read twice: pass a written report."""
    return df.unionByName(fallback_row(df.agg(F.count(F.lit(1)).alias("_n")).filter("_n = 0"), fallback, df.schema))


def fallback_row(rows: DataFrame, fallback: dict[str, Column], schema: T.StructType) -> DataFrame:
    """For every row of ``rows`` one row of ``schema`` with the ``fallback`` values, and nulls elsewhere."""
    return rows.select(*[fallback.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def suite_summary(
    spark, named: dict[str, Callable[[], DataFrame]], path: str | None = None, fallbacks: dict[str, dict[str, Column]] | None = None
) -> DataFrame:
    """(query, status, row_count, error) of a set of queries; their results are written to ``path/<query>``.

    Each is run by itself, whole, and written once; its rows are counted by the writer and in the files' footers. One
    that fails gives a FAILED row. Where a query has a fallback, an empty result is replaced by that one row.
    """
    path = path or new_path(spark, "reports")

    def run(name: str) -> tuple:
        try:
            made = named[name]()
            rows = write_counted(made, f"{path}/{name}")
            if rows == 0 and name in (fallbacks or {}):
                rows = 1
                write_parquet(fallback_row(spark.range(1), fallbacks[name], made.schema), f"{path}/{name}")
            return name, "SUCCESS", rows, None
        except (PySparkException, ValueError) as failure:
            return name, "FAILED", 0, str(failure).splitlines()[0][:500]

    # The queries do not depend on each other, so small ones fill the cores together.
    with ThreadPoolExecutor(PARALLEL_QUERIES) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(run), named))
    return spark.createDataFrame(rows, "query string, status string, row_count bigint, error string")
