"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_QUERIES an
optional comma-separated choice. The events table is first landed as a catalog
table (timed as ``land_catalog``); each query then runs from that table to a
consumed result, and shares nothing else with other queries.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from suite.base import Tables  # noqa: E402
from tremor.operators import charts, dedup, filters, stats, validate  # noqa: E402
from tremor.operators.dbscan import dbscan  # noqa: E402
from tremor.operators.ranking import batches  # noqa: E402
from tremor.learning.prepare import exact_medians, z_scores  # noqa: E402
from tremor.plans import etl, evaluation, master  # noqa: E402
from tremor.session import build_session  # noqa: E402

MEDIANS = ["magnitude", "depth", "felt", "cdi", "mmi", "sig", "nst", "dmin", "rms", "gap"]
CONTENT = ["region", "depth_category", "magnitude_hazard", "tsunami", "alert_level", "intensity_score"]

QUERIES = {
    "valid_events_by_region": lambda t: filters.valid_events(t.catalog).transform(
        lambda d: d.withColumn("region", master.classify.region(F.col("longitude"), F.col("latitude")))
    ).groupBy("region").count(),
    "etl_features": lambda t: etl.with_features(etl.clean(t.catalog)),
    "etl_zone_stats": lambda t: stats.zone_stats(etl.with_features(etl.clean(t.catalog))),
    "etl_relative_magnitudes": lambda t: etl.run(t.catalog),
    "enhanced_catalog": lambda t: etl.enhance(t.catalog),
    "evaluation_reports": lambda t: evaluation.summary(t.evaluated),
    "top_magnitude": lambda t: evaluation.top_magnitude(t.evaluated),
    "grid_density_hazard": lambda t: master.process(t.catalog),
    "dbscan": lambda t: dbscan(t.catalog),
    "zone_ranking": lambda t: master.zone_ranking(t.catalog),
    "exact_medians": lambda t: exact_medians(t.catalog, MEDIANS),
    "quartile_fences": lambda t: filters.within_quartile_fences(filters.good_quality(t.catalog)),
    "depth_by_region": lambda t: charts.five_numbers(etl.enhance(t.catalog), "region", "depth"),
    "duplicates": lambda t: dedup.duplicates(t.enhanced.select("id", *CONTENT), CONTENT),
    "latest_per_id": lambda t: dedup.latest_per_key(t.catalog, ["id"], ["updated", "time"]),
    "batches": lambda t: batches(t.catalog.select("id"), ["id"], 10_000),
    "z_scores": lambda t: z_scores(t.enhanced),
    "correlations": lambda t: stats.correlations(t.enhanced, ["magnitude", "depth", "hazard_score", "latitude", "longitude"]),
    "validation": lambda t: validate.check(t.catalog, validate.raw_rules()),
}


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.driver.memory": "16g", "spark.sql.shuffle.partitions": cpus,
        "spark.ui.showConsoleProgress": "false",
        # Test tables are a few megabytes: allow small partitions, so that all cores get work.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.sql.files.openCostInBytes": "128k", "spark.sql.files.maxPartitionBytes": "4m",
    })
    spark.sparkContext.setLogLevel("ERROR")
    began = time.perf_counter()
    catalog = Tables(spark, folder).catalog
    times = {"land_catalog": round(time.perf_counter() - began, 3)}
    for name in chosen.split(",") if chosen else QUERIES:
        fresh = Tables(spark, folder)
        fresh.catalog = catalog
        began = time.perf_counter()
        consume(QUERIES[name](fresh))
        times[name] = round(time.perf_counter() - began, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total time of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(folder).name.removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
