"""Run queries beside their SQL counterparts: python -m suite.check [-s folder] [name prefix ...]"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from tremor.session import build_session

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "tinyint": "INT", "smallint": "INT", "int": "INT", "bigint": "INT", "HUGEINT": "INT", "BIGINT": "INT",
    "INTEGER": "INT", "double": "DOUBLE", "string": "VARCHAR",
}


def local_session(cpus: int = 8) -> SparkSession:
    return build_session("check", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "10g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.sql.files.openCostInBytes": "128k", "spark.sql.files.maxPartitionBytes": "4m",
    })


def connect(folder: str):
    con = duckdb.connect()
    for name in NAMES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    return "NaN" if isinstance(v, float) and math.isnan(v) else v


def _same(a, b, tolerance: float) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or abs(a - b) <= tolerance
    return a == b and type(a) is type(b)


def _key(row) -> str:
    """Sort key that ignores the last digits of doubles."""
    return repr([round(v, 4) + 0.0 if isinstance(v, float) else v for v in row])


def _kind(name: str) -> str:
    return KINDS.get(name, name.upper())


def compare(df: DataFrame, con, sql: str, tolerance: float = 0.0) -> str:
    """An empty string if rows, columns and kinds agree, else the first difference.

    ``tolerance`` allows for a mean that lies exactly between two rounded values
    and falls to either side with the order of the additions.
    """
    rel = con.sql(sql)
    theirs_columns = sorted(rel.columns)
    ours_columns = sorted(df.columns)
    if ours_columns != theirs_columns:
        return f"columns {ours_columns} <> {theirs_columns}"
    ours_kind = {n: _kind(k) for n, k in df.dtypes}
    theirs_kind = {n: _kind(str(k)) for n, k in zip(rel.columns, rel.types)}
    ours = [tuple(_plain(v) for v in row) for row in df.select(*ours_columns).collect()]
    order = [rel.columns.index(c) for c in ours_columns]
    theirs = [tuple(_plain(row[i]) for i in order) for row in rel.fetchall()]
    if len(ours) != len(theirs):
        return f"rows {len(ours)} <> {len(theirs)}"
    ours.sort(key=lambda row: (_key(row), repr(row)))
    theirs.sort(key=lambda row: (_key(row), repr(row)))
    different = [(a, b) for a, b in zip(ours, theirs) if not all(_same(x, y, tolerance) for x, y in zip(a, b))]
    if different:
        a, b = different[0]
        parts = [f"{c}: {x!r} <> {y!r}" for c, x, y in zip(ours_columns, a, b) if not _same(x, y, tolerance)]
        return f"{len(different)} of {len(ours)} rows differ; " + "; ".join(parts)[:400]
    if ours_kind != theirs_kind:
        return f"kinds differ: { {n: (ours_kind[n], theirs_kind[n]) for n in ours_kind if ours_kind[n] != theirs_kind[n]} }"
    return ""


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("-s", "--sf", default="/root/testdata/sf0.01")
    parser.add_argument("prefixes", nargs="*")
    args = parser.parse_args()
    from suite import load

    queries, oracles = load()
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    bad = 0
    for name, run in queries.items():
        if args.prefixes and not any(name == p or name.startswith(p + "_") or (p.endswith("*") and name.startswith(p[:-1])) for p in args.prefixes):
            continue
        began = time.time()
        try:
            df = run(spark, args.sf)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                text = "ok" if not problem else f"DIFF {problem}"
            else:
                text = f"rows {df.count()}"
                problem = ""
        except Exception as error:  # report and go on
            problem = text = f"ERROR {type(error).__name__}: {str(error)[:500]}"
        bad += bool(problem)
        print(f"{name:34s} {time.time() - began:6.2f}s  {text}", flush=True)
    print(f"{bad} problems")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
