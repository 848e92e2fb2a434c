"""Writers."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.operators.dedup import missing_parents
from tremor.operators.filters import normalise_schema, select_columns
from tremor.workspace import file_system, materialise, new_path

# Columns a relational target takes; vectors and structs stay behind.
RELATIONAL_COLUMNS = (
    "id", "magnitude", "place", "time", "longitude", "latitude", "depth", "felt", "cdi", "mmi",
    "alert_standardized", "tsunami", "sig", "year", "month", "day", "hour", "magnitude_category",
    "depth_category_detailed", "geographic_zone", "risk_score", "energy_release_log",
    "population_impact_estimate", "tectonic_activity_score", "ring_of_fire_distance",
    "magnitude_vs_regional_avg", "magnitude_vs_monthly_avg",
)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header, quotes inside a field doubled. ``single_file`` is for small aggregates: it writes from one task."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_formats(df: DataFrame, path: str, sources: list[str], time: str = "time") -> DataFrame:
    """Parquet, CSV and JSON copies plus a one-row description, which is returned.

    CSV and JSON are written from the Parquet copy, so ``df`` runs once. Nested
    columns go into CSV as JSON text.
    """
    spark = df.sparkSession
    write_parquet(df, f"{path}/data.parquet")
    stored = spark.read.schema(df.schema).parquet(f"{path}/data.parquet")
    nested = (T.StructType, T.ArrayType, T.MapType)
    flat = stored.withColumns({f.name: F.to_json(f.name) for f in df.schema.fields if isinstance(f.dataType, nested)})
    write_csv(flat, f"{path}/data.csv")
    stored.write.mode("overwrite").json(f"{path}/data.json")
    description = stored.agg(
        F.count(F.lit(1)).alias("total_records"), F.min(time).alias("first_time"), F.max(time).alias("last_time")
    ).withColumns({
        "collection_date": F.current_timestamp(),
        "features_included": F.lit(list(df.columns)),
        "data_sources": F.lit(list(sources)),
        "parquet_bytes": F.lit(folder_bytes(df, f"{path}/data.parquet")),
        "csv_bytes": F.lit(folder_bytes(df, f"{path}/data.csv")),
        "json_bytes": F.lit(folder_bytes(df, f"{path}/data.json")),
    })
    description.write.mode("overwrite").json(f"{path}/metadata.json")
    return description


def folder_bytes(df: DataFrame, path: str) -> int:
    """Size of a written folder on any Hadoop file system."""
    jvm, system = _system(df.sparkSession, path)
    return int(system.getContentSummary(jvm.org.apache.hadoop.fs.Path(path)).getLength())


def write_jdbc(
    df: DataFrame, table: str, url: str, properties: dict[str, str], mode: str = "overwrite",
    target: T.StructType | None = None, batch_size: int = 1000, fallback: str | None = None,
) -> bool:
    """Write the relational columns to a database; False if there is no connection and it fell back to Parquet.

    ``target`` aligns the columns to an existing table before an append. The connection is tried before anything is
    written or dropped; errors of the plan or of the write itself are raised.
    """
    aligned = normalise_schema(df, target) if target else select_columns(df, RELATIONAL_COLUMNS)
    if fallback is not None and not _connects(df, url, properties):
        write_parquet(df, fallback)
        return False
    aligned.write.mode(mode).option("batchsize", batch_size).jdbc(url, table, properties=properties)
    return True


def _connects(df: DataFrame, url: str, properties: dict[str, str]) -> bool:
    try:
        df.sparkSession.read.jdbc(url, "(SELECT 1 AS one) AS probe", properties=properties).schema  # noqa: B018
        return True
    except Exception:  # no driver, no server, no permission
        return False


def parquet(df: DataFrame, path: str) -> None:
    df.write.parquet(path)


def write_counted(df: DataFrame, path: str, write: Callable[[DataFrame, str], None] = parquet) -> int:
    """Write ``df`` as Parquet and return its rows: those that reached the writer, which must be those in the files.

    The first number is observed while the table is written, the second comes from the footers of the files, so the
    check reads no data.
    """
    handed = Observation()
    write(df.observe(handed, F.count(F.lit(1)).alias("rows")), path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path).count()
    if handed.get["rows"] != stored:
        raise ValueError(f"{path}: {handed.get['rows']} rows were handed to the writer, {stored} are in the files")
    return stored


def refresh_tables(
    tables: dict[str, DataFrame], path: str, references: tuple[tuple[str, str, str, str], ...] = (),
    write: Callable[[DataFrame, str], None] = parquet,
) -> DataFrame:
    """Replace a set of stored tables as one; returns (table_name, rows).

    Every table is written into a new version folder ``path/v=<id>``. Only after all are there, have as many rows as
    were handed to the writer (:func:`write_counted`), and satisfy ``references`` (child, key, parent, parent key), the
    pointer file is switched. Readers (:func:`current_version`) see the old version until then; a failure, or a table
    made from its own old version, does it no harm.
    """
    spark = next(iter(tables.values())).sparkSession
    version = f"{path}/v={uuid.uuid4().hex[:12]}"
    counts = [(name, write_counted(df, f"{version}/{name}", write)) for name, df in tables.items()]
    stored = {name: spark.read.schema(df.schema).parquet(f"{version}/{name}") for name, df in tables.items()}
    for child, key, parent, parent_key in references:
        lost = missing_parents(stored[child], stored[parent], key, parent_key).limit(1).count()
        if lost:
            raise ValueError(f"{child}.{key} has values that are not in {parent}.{parent_key}; the stored tables stay as they are")
    _point_to(spark, path, version)
    return spark.createDataFrame(counts, "table_name string, rows bigint")


def _system(spark, path: str):
    return spark._jvm, file_system(spark, path)[1]


def _point_to(spark, path: str, version: str) -> None:
    """Name the version readers use: a new pointer with a higher number, written whole and then renamed into place."""
    jvm, system = _system(spark, path)
    number = max([n for n, _ in _pointers(spark, path)], default=0) + 1
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}/_draft-{uuid.uuid4().hex}")
    out = system.create(draft, False)
    out.write(bytearray(version.rsplit("/", 1)[1].encode()))
    out.close()
    if not system.rename(draft, jvm.org.apache.hadoop.fs.Path(f"{path}/_pointer-{number:010d}")):
        raise RuntimeError(f"another refresh of {path} has finished meanwhile")


def _pointers(spark, path: str) -> list[tuple[int, str]]:
    jvm, system = _system(spark, path)
    found = system.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/_pointer-*")) or []
    return [(int(s.getPath().getName().rsplit("-", 1)[1]), s.getPath().toString()) for s in found]


def current_version(spark, path: str) -> str:
    """The folder of the version that :func:`refresh_tables` has made current."""
    pointers = _pointers(spark, path)
    if not pointers:
        raise FileNotFoundError(f"no stored version in {path}")
    jvm, system = _system(spark, path)
    stream = system.open(jvm.org.apache.hadoop.fs.Path(max(pointers)[1]))
    try:
        name = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{path}/{name}"


def read_stored(spark, path: str, name: str) -> DataFrame:
    """A table of the current version."""
    return spark.read.parquet(f"{current_version(spark, path)}/{name}")


def append_by_month(df: DataFrame, path: str, time: str = "datetime_local", batch: str | None = None) -> None:
    """Append into one folder per local month and ``batch``. Rebalancing gathers small months and splits busy
    ones over several tasks by measured size.

    A batch that is appended again, after a failure or by mistake, replaces its own rows, so the table is the same
    as after the first time. Without a name every call is a batch of its own.
    """
    month = F.date_format(F.date_trunc("month", time), "yyyy-MM")
    tagged = df.withColumns({"month_batch": month, "batch": F.lit(batch or uuid.uuid4().hex)})
    _overwrite_parts(tagged.hint("rebalance", F.col("month_batch")), path)


def _overwrite_parts(tagged: DataFrame, path: str) -> None:
    """Replace the folders ``tagged`` has rows for, and leave all others alone."""
    writer = tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("month_batch", "batch").parquet(path)


def read_months(spark, path: str) -> DataFrame:
    """The table that :func:`append_by_month` keeps, with month_batch and batch as text."""
    found = spark.read.parquet(path)
    return found.withColumns({c: F.col(c).cast("string") for c in ("month_batch", "batch")})


def change_months(spark, path: str, touched: Column, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply ``change`` to the months with a row that ``touched`` holds for; (month_batch, batch, rows_before, rows_after).

    Only those months are read as a whole and written again; files of all others stay as they are. ``change`` keeps
    month_batch and batch, and must give the same result when applied again: a change that was interrupted is
    completed by repeating it. Folders left without rows are removed.
    """
    stored = read_months(spark, path)
    parts = ["month_batch", "batch"]
    hit = materialise(stored.filter(touched).select("month_batch").distinct(), "touched-months")
    # Months of a catalog are few; their names become a partition filter.
    months = [row[0] for row in hit.collect()]
    before = stored.filter(F.col("month_batch").isin(months))
    after = materialise(change(before), "changed-months")
    counts = materialise(
        before.groupBy(*parts).agg(F.count(F.lit(1)).alias("rows_before"))
        .join(after.groupBy(*parts).agg(F.count(F.lit(1)).alias("rows_after")), parts, "left")
        .withColumn("rows_after", F.coalesce("rows_after", F.lit(0))),
        "change-counts",
    )
    if months:
        _overwrite_parts(after.hint("rebalance", F.col("month_batch")), path)
    for row in counts.filter("rows_after = 0").collect():
        location, system = file_system(spark, f"{path}/month_batch={row['month_batch']}/batch={row['batch']}")
        system.delete(location, True)
    return counts


def replace_table(df: DataFrame, path: str) -> None:
    """Make ``df``, which may be read from the table itself, the content of the stored table; read it with
    ``read_stored(spark, path, "table")``."""
    refresh_tables({"table": df}, path)


def write_report(report: DataFrame, path: str) -> None:
    """A one-row report as JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)


def scratch_path(df: DataFrame, label: str) -> str:
    return new_path(df.sparkSession, label)


def to_table_types(df: DataFrame, schema: T.StructType, defaults: dict[str, Column] | None = None) -> DataFrame:
    """Round to the decimals of the stored table and order its columns."""
    return normalise_schema(df, schema, defaults)
