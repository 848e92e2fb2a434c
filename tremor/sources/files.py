"""Flat-file and table readers."""

from __future__ import annotations

import csv
import io
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.functions.temporal import from_millis, parse_time
from tremor.functions.text import nan_to_null
from tremor.schemas import CATALOG, EVALUATION_CATALOG, RAW_CATALOG
from tremor.workspace import file_system

# What is read of a file to know its columns, and how many files are opened at the same time.
HEADER_BYTES, HEADER_READERS = 4096, 16
REQUIRED = ("id", "latitude", "longitude", "magnitude")


def read_catalog(spark: SparkSession, path: str, schema: T.StructType = CATALOG) -> DataFrame:
    """Read by file extension: parquet, csv with header, or json lines."""
    kind = path.lower().rstrip("/").rsplit(".", 1)[-1]
    reader = spark.read.schema(schema)
    if kind == "parquet":
        found = reader.parquet(path)
    elif kind == "csv":
        return coerce(read_csv_by_name(spark, path), schema)
    elif kind == "json":
        found = reader.json(path)
    else:
        raise ValueError(f"unsupported file format: {path}")
    return nan_to_null(found)


def read_csv_by_name(spark: SparkSession, path: str, line_breaks: bool = False) -> DataFrame:
    """The columns of a CSV file or folder as text, each picked by its name in the header of its own file.

    Files may order their columns differently, lack some, or have more: a column is the union over the files, NULL
    where a file lacks it. Files of one layout are read together; of each file only the first kilobytes are read to
    know its layout. A header that names a column twice raises. Fields may hold commas and quotes, and line breaks if
    ``line_breaks`` says so: a file is then read by one task, since a break no longer ends a record.
    """
    names = csv_files(spark, path)
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        headers = list(pool.map(lambda name: read_header(spark, name), names))
    layouts: dict[tuple[str, ...], list[str]] = {}
    for name, columns in zip(names, headers):
        if columns is not None:
            layouts.setdefault(columns, []).append(name)
    found = None
    for columns, members in sorted(layouts.items()):
        if len(set(columns)) < len(columns):
            raise ValueError(f"a column is named twice in the header of {members[0]}: {columns}")
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
        part = reader.option("multiLine", line_breaks).option("escape", '"').csv(members)
        found = part if found is None else found.unionByName(part, allowMissingColumns=True)
    if found is None:
        raise ValueError(f"no header in {path}")
    return found


def csv_files(spark: SparkSession, path: str) -> list[str]:
    """The files a reader would take in a file, folder or pattern, in order of their names."""
    location, system = file_system(spark, path)
    found, folders = [], [s for s in system.globStatus(location) or []]
    if not folders:
        raise FileNotFoundError(path)
    while folders:
        status = folders.pop()
        if status.isDirectory():
            inside = system.listStatus(status.getPath())
            folders.extend(s for s in inside if s.getPath().getName()[0] not in "_.")
        elif status.getLen():
            found.append(status.getPath().toString())
    return sorted(found)


def read_header(spark: SparkSession, name: str, size: int = HEADER_BYTES) -> tuple[str, ...] | None:
    """The column names in the first record of a file; None if there is none. Reads ``size`` bytes, more only if the record is longer."""
    location, system = file_system(spark, name)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(system.getConf()).getCodec(location)
    stream = system.open(location)
    try:
        data = bytes((codec.createInputStream(stream) if codec else stream).readNBytes(size))
    finally:
        stream.close()
    # A record that fills all that was read may go on; the decoder leaves out a character that was cut.
    text = data.decode("utf-8-sig", errors="ignore")
    records = csv.reader(io.StringIO(text, newline=""))
    first = next((r for r in records if r), None)
    if len(data) == size and next(records, None) is None:
        return read_header(spark, name, size * 16)
    return tuple(first) if first else None


def coerce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast every column of ``schema``; values that do not fit become NULL, absent columns too."""
    return nan_to_null(df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ]))


def load_raw(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(catalog, rejects): raw 14-field records with typed columns and real timestamps.

    A record is rejected if a required field is missing or a given value does
    not fit its type.
    """
    typed = [
        F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in records.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in RAW_CATALOG.fields
    ]
    kept = records.select(F.struct(*records.columns).alias("_given"), *typed)
    broken = F.lit(False)
    for f in RAW_CATALOG.fields:
        if f.name in REQUIRED:
            broken = broken | F.col(f.name).isNull()
        elif f.name in records.columns:
            broken = broken | (F.col(f"_given.{f.name}").isNotNull() & F.col(f.name).isNull())
    good = kept.filter(~broken).drop("_given").withColumns({
        "time": from_millis(F.col("time"), truncate=True),
        "extraction_timestamp": from_millis(F.col("extraction_timestamp"), truncate=True),
    })
    return nan_to_null(good), kept.filter(broken).select("_given.*")


def read_evaluation_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header: seven columns picked by name, ``time`` parsed from text."""
    picked = coerce(read_csv_by_name(spark, path), EVALUATION_CATALOG)
    return picked.withColumn("time", parse_time(F.col("time")))


def read_text_catalog(
    spark: SparkSession, path: str, numeric: list[str], times: list[str]
) -> DataFrame:
    """All-text CSV, then numbers and times; unreadable values become NULL."""
    raw = read_csv_by_name(spark, path)
    return nan_to_null(raw.withColumns({
        **{c: F.col(c).try_cast("double") for c in numeric}, **{c: parse_time(F.col(c)) for c in times},
    }))


def read_table(
    spark: SparkSession, name: str, url: str | None = None, properties: dict[str, str] | None = None,
    partition: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """A catalog table, or a JDBC table if ``url`` is given.

    ``partition`` is (column, lower, upper, parts); without it a JDBC read is a
    single task, fit for small tables only.
    """
    if url is None:
        return spark.table(name)
    options = {}
    if partition:
        column, low, high, parts = partition
        options = {"column": column, "lowerBound": low, "upperBound": high, "numPartitions": parts}
    return spark.read.jdbc(url, name, properties=properties or {}, **options)
