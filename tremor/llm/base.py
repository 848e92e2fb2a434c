"""Helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space that separates words, as a Java regular expression class body.
SPACE = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Joins broadcast their written right side up to this many rows.
SMALL_ROWS = 100_000
# Rows of an Arrow batch where each holds whole sets or texts.
BATCH_ROWS = 1_000


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def plain(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) alone, null text as empty; other columns, whatever their names, stay out of the operators."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z alone in lower case."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def ship_by_value(module: str) -> None:
    """Send the functions of ``module`` to the Python workers themselves, so that they need not find the library."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def per_process(key, build: Callable):
    """``build()`` once per Python worker, however many tasks it runs."""
    held = sys.modules.setdefault("_tremor_held", types.ModuleType("_tremor_held")).__dict__
    if key not in held:
        held[key] = build()
    return held[key]


def forget_held() -> None:
    """Let go of what this Python worker holds for other operators; a worker is reused by the stages that follow."""
    sys.modules.setdefault("_tremor_held", types.ModuleType("_tremor_held")).__dict__.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside hand Python ``BATCH_ROWS`` rows at a time; rows of two shingle sets each are wide."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The values of the named columns, row by row."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            yield from zip(*[part.column(n).to_pylist() for n in names])


def in_chunks(rows: Iterator[tuple], make: Callable[[list], pa.RecordBatch], size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Record batches made from ``size`` results each."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield make(held)
            held = []
    if held:
        yield make(held)


ship_by_value(__name__)
