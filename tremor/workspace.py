"""Written intermediate tables.

Iterative operators and values that are read more than once go through a
Parquet table in the shared checkpoint folder. That cuts the lineage, survives
the loss of executors, and gives the optimizer true sizes for later joins.
"""

from __future__ import annotations

import gc
import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_local_folders: dict[str, str] = {}
_scopes = threading.local()


def folder(spark: SparkSession) -> str:
    """The shared scratch folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a fresh temporary folder; a
    cluster session must name one, since machine-local paths are not shared.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tremor-")
    return _local_folders[app]


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    for written in getattr(_scopes, "open", [])[-1:]:
        written.append(path)
    return path


def file_system(spark: SparkSession, path: str):
    """(path, its Hadoop file system)."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    if not path.startswith(f"{folder(spark)}/"):
        raise ValueError(f"{path} is not in the scratch folder")
    location, system = file_system(spark, path)
    system.delete(location, True)


def settled(spark: SparkSession, make: Callable[[], DataFrame], label: str = "result") -> DataFrame:
    """Write the result of ``make``, delete the scratch tables written on the way, and return a scan of the result.

    The result has no lineage into the deleted tables, so lost executors only read it again. Scopes may be nested. The
    shuffle files of the finished jobs go too: Spark removes them once the driver has let go of their plans.
    """
    if not hasattr(_scopes, "open"):
        _scopes.open = []
    _scopes.open.append([])
    try:
        df = make()
        target = new_path(spark, label)
        df.write.parquet(target)
    finally:
        written = _scopes.open.pop()
    for path in written:
        if path != target:
            discard(spark, path)
    for outer in _scopes.open[-1:]:
        outer.append(target)
    schema = df.schema
    del make, df
    gc.collect()
    spark._jvm.java.lang.System.gc()
    return spark.read.schema(schema).parquet(target)


def materialise(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once and return a scan of the written table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def constants(one_row: DataFrame) -> dict[str, Column]:
    """The values of a one-row aggregate as typed literals.

    One job, however many values are used afterwards; scalar subqueries would
    scan the data once per value.
    """
    row = one_row.first()
    return {f.name: F.lit(row[f.name]).cast(f.dataType) for f in one_row.schema.fields}
