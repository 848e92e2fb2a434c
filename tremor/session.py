"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Semantics every result depends on; both can be changed on a running session.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Physical settings for a cluster. Partition counts are left to AQE, which
# starts from many small partitions and merges them by measured size.
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "tremor", master: str | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**TUNING, **SEMANTICS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_semantics(spark: SparkSession) -> SparkSession:
    """Pin time zone and ANSI mode on a session somebody else created."""
    for key, value in SEMANTICS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark
