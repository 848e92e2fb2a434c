"""Exact deduplication by a keyed streaming state.

A Structured Streaming query reads the documents file by file. Its state, kept on the executors' disks
(RocksDB) and in the checkpoint folder, has one entry per digest and never expires: the number of rows, and the
row that stays with its stable identifier (doc_id) and the locator of its content (file and row in the file).
A digest met again is only a hit: afterwards the full normalised texts of all hits are compared with the text
at the locator, and texts that merely share a digest are told apart. Everything runs in DataFrame operations.

Scale: the stream moves digests and locators, pre-aggregated per task; a text that fills a third of the rows is
one row per task. Texts move only for digests with hits, again one per task and text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.llm.base import SMALL_ROWS, ascii_lower
from tremor.operators.skew import balanced_join, is_small
from tremor.workspace import materialise, new_path

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Else every state partition reserves megabytes of disk for files that stay small.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
# A micro-batch takes at most so many new files.
FILES_PER_BATCH = 10_000


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _located(docs: DataFrame, digest: Callable[[Column], Column], id_col: str, text_col: str) -> DataFrame:
    """Rows of a file source: the row's place, its normalised text, and two digests of that."""
    where = F.struct(
        F.col(id_col).alias("doc_id"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("line")
    )
    normal = docs.select(where.alias("row"), ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("normal"))
    return normal.select("row", "normal", digest(F.col("normal")).alias("digest"))


def follow(rows: DataFrame) -> DataFrame:
    """Run the stream over the files that are there: (digest, keep, n) per digest, from the keyed state."""
    spark = rows.sparkSession
    seen = new_path(spark, "dedup-seen")
    counted = rows.groupBy("digest").agg(F.max("row").alias("keep"), F.count(F.lit(1)).alias("n"))

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{seen}/batch={number}")

    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    try:
        for key, value in STATE_STORE.items():
            spark.conf.set(key, value)
        query = (
            counted.writeStream.outputMode("update").foreachBatch(store)
            .option("checkpointLocation", new_path(spark, "dedup-state")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    if query.lastProgress is None:  # no file, no batch
        return spark.createDataFrame([], counted.schema)
    # Every entry grows from batch to batch; the last version of a digest is its largest.
    versions = spark.read.schema(counted.schema).parquet(f"{seen}/batch=*")
    return versions.groupBy("digest").agg(F.max("keep").alias("keep"), F.max("n").alias("n"))


def exact_duplicates(
    spark: SparkSession,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """One row per row of the Parquet files at ``path``: doc_id, keep_id, group_size, kept, text_sha256, row.

    Texts are equal if identical after lower-casing A-Z; a null text counts as empty, and all empty texts are
    equal. Of equal texts the row with the largest doc_id stays; a null doc_id is smaller than any other, and
    rows that repeat a doc_id with its text are ordered by place, so exactly one row of a group is kept. ``row``
    is the row's place (doc_id, file, line). An empty table gives an empty result; other columns are not read.
    """
    schema = spark.read.parquet(path).select(id_col, text_col).schema
    # As a pattern, the path may be a folder or a single file; a plain path must be a folder.
    pattern = f"{path[:-1]}[{path[-1]}]"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(pattern)
    state = materialise(follow(_located(stream, digest, id_col, text_col).drop("normal")), "dedup-state-read")
    source = _located(spark.read.schema(schema).parquet(path), digest, id_col, text_col)

    # The bytes of all hits, one row per task and text, beside the text at the state's locator.
    hits = state.filter("n > 1").select("digest", F.col("keep").alias("at"))
    narrow = F.broadcast(hits) if is_small(hits, SMALL_ROWS) else hits
    texts = materialise(
        source.join(narrow, "digest").groupBy("digest", "normal")
        .agg(F.max("row").alias("keep"), F.count(F.lit(1)).alias("n"), F.max(F.col("row") == F.col("at")).alias("located"))
        .select("digest", F.when(~F.col("located"), F.col("normal")).alias("other"), "keep", "n"),
        "dedup-texts",
    )
    # A text other than the located one has met a digest that is not its own.
    mixed = texts.join(texts.filter("other is not null").select("digest").distinct(), "digest", "left_semi")
    sha = sha256(F.col("normal")) if digest is not sha256 else F.col("digest")
    collision = not is_small(mixed, 0)
    groups = state.select("digest", "keep", "n")
    ids = source.select("row", "digest", sha.alias("sha"), *["normal"] * collision)
    if collision:
        apart = materialise(mixed, "dedup-collisions")
        alone = apart.select("digest").distinct()
        others = ids.join(alone, "digest", "left_semi").join(
            apart.withColumn("normal", F.col("other")).filter("other is not null").drop("other"), ["digest", "normal"], "left"
        )
        first = apart.filter("other is null").select("digest", F.col("keep").alias("k0"), F.col("n").alias("n0"))
        others = others.join(first, "digest").select(
            "row", "digest", "sha", F.coalesce("keep", "k0").alias("keep"), F.coalesce("n", "n0").alias("n")
        )
        ids = ids.join(alone, "digest", "left_anti").drop("normal")
    ids = materialise(ids, "dedup-ids")
    joined = balanced_join(ids, groups, ["digest"], "inner", ["row"], limit=SMALL_ROWS)
    if collision:
        joined = joined.unionByName(others)
    return joined.select(
        F.col("row.doc_id").alias("doc_id"), F.col("keep.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "row",
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; ``docs`` is written once, for the stream to follow."""
    spark, path = docs.sparkSession, new_path(docs.sparkSession, "dedup-input")
    docs.write.parquet(path)
    found = exact_duplicates(spark, path, id_col, text_col)
    gone = materialise(found.filter(~F.col("kept")).select(F.col("row.file").alias("_file"), F.col("row.line").alias("_line")), "dedup-dropped")
    rows = spark.read.schema(docs.schema).parquet(path).select(
        F.struct(*docs.columns).alias("_doc"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_line")
    )
    right = F.broadcast(gone) if is_small(gone, SMALL_ROWS) else gone
    return rows.join(right, ["_file", "_line"], "left_anti").select("_doc.*")
