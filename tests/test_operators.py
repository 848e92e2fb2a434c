"""Operators on small tables, against plain Python."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tremor.operators import augment, charts, dedup, density, digests, filters, maintain, ranking, skew, stats, validate
from tremor.operators.components import connected_components


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows in one group, and many equal values."""
    rng = random.Random(5)
    rows = [(f"r{i:04d}", "hot" if i % 2 else f"g{i % 7}", float(rng.randint(0, 40))) for i in range(2000)]
    rows += [("n1", None, 3.0), ("n2", None, 5.0)]
    return spark.createDataFrame(rows, "id string, g string, x double").repartition(4, "id").cache(), rows


def test_row_numbers_over_slabs(skewed):
    df, rows = skewed
    got = {r["id"]: r["rn"] for r in ranking.row_numbers(df, ["g"], ["x", "id"], slabs=7).collect()}
    groups = {}
    for i, g, x in rows:
        groups.setdefault(g, []).append((x, i))
    want = {i: n for members in groups.values() for n, (_, i) in enumerate(sorted(members), 1)}
    assert got == want


def test_running_total_over_slabs(skewed):
    df, rows = skewed
    got = {r["id"]: r["t"] for r in ranking.running_total(df, [], ["id"], F.col("x"), "t", slabs=5).collect()}
    total, want = 0, {}
    for i, _, x in sorted(rows):
        total += int(x)
        want[i] = total
    assert got == want


def test_exact_quantiles(skewed):
    df, rows = skewed
    got = {(r["g"], r["probability"]): r["quantile"] for r in ranking.exact_quantiles(df, ["g"], "x", [0.0, 0.25, 0.5, 1.0], slabs=6).collect()}
    groups = {}
    for _, g, x in rows:
        groups.setdefault(g, []).append(x)
    assert len(got) == 4 * len(groups)
    for g, xs in groups.items():
        q1, median, _ = statistics.quantiles(xs, n=4, method="inclusive")
        assert got[g, 0.25] == pytest.approx(q1) and got[g, 0.5] == pytest.approx(median)
        assert (got[g, 0.0], got[g, 1.0]) == (min(xs), max(xs))


def test_quantiles_ignore_nan_and_null(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "x double")
    assert ranking.exact_quantiles(df, [], "x", [0.5]).first()["quantile"] == 2.0


def test_batches(spark):
    df = spark.range(95).select(F.format_string("%03d", "id").alias("id")).repartition(3)
    got = {r["id"]: r["batch"] for r in ranking.batches(df, ["id"], 10).collect()}
    assert got == {f"{i:03d}": i // 10 for i in range(95)}


@pytest.mark.parametrize("how, limit, per", [
    ("left", 1000, 10), ("inner", 3, 100), ("left", 3, 100), ("left_semi", 3, 100), ("left_anti", 3, 100), ("left", 3, 1),
])
def test_balanced_join_equals_join(spark, skewed, how, limit, per):
    """Broadcast, salted, and plain shuffle give the rows of an ordinary join."""
    df, _ = skewed
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("g1", 3), ("g9", 4), (None, 5)], "g string, y int")
    got = skew.balanced_join(df, right, ["g"], how, ["id"], limit=limit, rows_per_split=per)
    want = df.join(right, ["g"], how)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("limit", [1000, 3])
def test_balanced_join_null_keys(spark, skewed, limit):
    df, _ = skewed
    right = spark.createDataFrame([("hot", 1), ("g1", 3), ("g9", 4), (None, 5)], "g string, y int")
    got = skew.balanced_join(df, right, ["g"], "inner", ["id"], limit=limit, rows_per_split=100, nulls_match=True)
    assert got.columns == ["id", "g", "x", "y"] and got.filter("g is null").count() == 2


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
@pytest.mark.parametrize("rows,partners", [(60, 3000), (3000, 60), (3000, 3000), (3000, 0), (0, 3000)])
@pytest.mark.parametrize("most", [None, 1])
def test_narrowed_join_equals_join(spark, how, rows, partners, most):
    """Either side smaller, empty sides, null and repeated keys, two keys of two types, with a digest and without."""
    rng = random.Random(rows + partners)

    def table(n):
        made = [(rng.choice([None, "hot", *map(str, range(2000))]), rng.choice([None, 1, 2, 3]), i) for i in range(n)]
        return spark.createDataFrame(made + [("hot", 1, -i) for i in range(n // 2)], "k string, `a b` bigint, v int")

    left, right = table(rows).withColumn("block", F.lit(1)), table(partners)
    for keys in (["k"], ["a b", "k"]):
        got = digests.narrowed_join(left, right, keys, how, ["v"], limit=0, rows_per_split=100, most_bytes=most)
        want = left.join(right.select(*keys), keys, how).select(*left.columns)
        assert sorted(map(str, got.select(*left.columns).collect())) == sorted(map(str, want.collect()))


def test_digest_keeps_rows_out_of_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(200_000).withColumn("v", F.hash("id")).write.parquet(path)
    rows, wanted = spark.read.parquet(path), spark.range(5_000, 100_000, 97).select("id")
    digest = digests.key_digest(wanted, ["id"], digests.slots_for(wanted.count()))
    found = digest.possible(rows)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,5000)" in plan and "SortMergeJoin" not in plan
    met = {r["id"] for r in found.collect()}
    assert {r["id"] for r in wanted.collect()} <= met and len(met) < 0.2 * 95_000
    assert digests.narrowed_join(rows, wanted, ["id"], "left_anti", limit=0).count() == 200_000 - wanted.count()


def test_digest_size_is_bounded():
    assert digests.slots_for(0) == digests.BLOCK_BITS and digests.slots_for(1 << 20) == 1 << 23
    assert digests.slots_for(200_000_000) == 8 * digests.DIGEST_BYTES and digests.slots_for(10**9) is None


def test_no_digest_for_keys_of_two_types(spark):
    left, right = spark.range(10).select(F.col("id").cast("int").alias("k")), spark.range(5, 40).withColumnRenamed("id", "k")
    assert digests.narrowed_join(left, right, ["k"], "left_anti", limit=0).count() == 5
    left, right = (spark.createDataFrame([(x,)], "k double") for x in (0.0, -0.0))
    assert digests.narrowed_join(left, right, ["k"], "left_semi", limit=0).count() == 1


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 30)] + [(300 + rng.randint(0, 50), 300 + rng.randint(0, 50)) for _ in range(40)]
    edges += [(1000, x) for x in range(1001, 1060)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        parent[max(ra, rb)] = min(ra, rb)
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    df = spark.createDataFrame(edges, "u long, v long")
    assert {r["node"]: r["label"] for r in connected_components(df, limit=20).collect()} == want


def test_duplicates_and_survivors(skewed):
    df, rows = skewed
    extra = dedup.duplicates(df, ["g", "x"]).collect()
    kept = dedup.without_duplicates(df, ["g", "x"]).collect()
    groups = {}
    for i, g, x in rows:
        groups.setdefault((g, x), []).append(i)
    assert sorted(r["id"] for r in kept) == sorted(min(v) for v in groups.values())
    assert {(r["id"], r["rn"]) for r in extra} == {(i, n) for v in groups.values() for n, i in enumerate(sorted(v), 1) if n > 1}


def test_first_per_key_prunes_before_the_shuffle(skewed):
    df, _ = skewed
    plan = dedup.without_duplicates(df, ["g"])._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


def events(spark, rows):
    return spark.createDataFrame(rows, "id string, latitude double, longitude double, magnitude double, depth double")


def test_valid_events(spark):
    nan = float("nan")
    df = events(spark, [
        ("ok", 90.0, -180.0, 0.1, 0.0), ("lat", 90.1, 0.0, 1.0, 0.0), ("zero", 0.0, 0.0, 0.0, 0.0), ("nan", 0.0, 0.0, nan, 0.0),
        ("deep", 0.0, 0.0, 1.0, -0.1), ("null", 0.0, 0.0, 1.0, None), (None, 0.0, 0.0, 1.0, 1.0),
    ])
    assert [r["id"] for r in filters.valid_events(df).collect()] == ["ok"]
    assert {r["id"] for r in filters.valid_stream_events(df).collect()} == {"ok", "deep", "null", None}


def test_box_across_the_meridian(spark):
    df = events(spark, [("a", 0.0, 170.0, 1.0, 0.0), ("b", 0.0, -170.0, 1.0, 0.0), ("c", 0.0, 0.0, 1.0, 0.0)])
    assert {r["id"] for r in filters.select_catalog(df, bounds=(120, -60, -10, 50)).collect()} == {"a", "b"}


def test_required_columns(spark):
    with pytest.raises(ValueError, match="depth"):
        filters.require_columns(spark.range(1), ["id", "depth"])


def test_quartile_fences(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 5, 100]], "magnitude double")
    assert sorted(r[0] for r in filters.within_quartile_fences(df).collect()) == [1, 2, 3, 4, 5]


def test_grid_edges(spark):
    df = events(spark, [("min", 0.0, 0.0, 5.0, 1.0), ("near", 0.05, 0.05, 5.0, 1.0), ("edge", 0.1, 0.1, 5.0, 1.0), ("far", 0.15, 0.0, 5.0, 1.0)])
    first = {r["id"]: r["spatial_density"] for r in density.with_density(df).collect()}
    assert first["min"] == first["near"] == first["edge"] == pytest.approx(3 / 11.1**2) and first["far"] == pytest.approx(1 / 11.1**2)
    dropped = {r["id"]: r["spatial_density"] for r in density.with_density(df, edge="drop").collect()}
    assert dropped["min"] is None and dropped["far"] is None and dropped["near"] == pytest.approx(2 / 11.1**2)


def test_maintenance_leaves_null_conditions_alone(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 9.0)], "id string, depth double")
    after, gone = maintain.delete(df, F.col("depth") < 5)
    assert {r["id"] for r in after.collect()} == {"b", "c"} and [r["id"] for r in gone.collect()] == ["a"]
    after, hit = maintain.update(df, F.col("depth") < 5, {"depth": F.lit(0.0)})
    assert {r["id"]: r["depth"] for r in after.collect()} == {"a": 0.0, "b": None, "c": 9.0} and hit.count() == 1


@pytest.mark.parametrize("blocked", [True, False])
def test_insert_unless(spark, blocked):
    df = spark.createDataFrame([("a", 1.0)], "id string, depth double")
    rows = spark.createDataFrame([("new", 2)], "id string, depth int")
    blocker = df.filter(F.lit(blocked))
    after, added = maintain.insert_unless(df, rows, blocker)
    assert after.count() == (1 if blocked else 2) and added.count() == (0 if blocked else 1)


def test_rules_and_strict_report(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 99.0), ("c", None)], "id string, magnitude double")
    results = validate.check(df, [
        validate.row_count(1, 3), validate.not_null("id"), validate.not_null("id", 0.6), validate.between("magnitude", 0, 10),
        validate.in_set("id", ["a", "c"])])
    assert [(r["failed"], r["passed"]) for r in results.orderBy("rule").collect()] == [(0, True), (1, False), (1, True), (1, False), (0, True)]
    assert validate.report(results).first()["failed_expectations"] == 2
    with pytest.raises(validate.ValidationError):
        validate.report(results, strict=True)
    assert validate.report(results.filter("passed"), strict=True).first()["success"]


def test_histogram_closes_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 2, 3, 4)], "x double")
    assert [r["events"] for r in charts.histogram(df, "x", 4).orderBy("bin").collect()] == [1, 1, 1, 2]
    same = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r["events"] for r in charts.histogram(same, "x", 3).orderBy("bin").collect()] == [2, 0, 0]


def test_sample_is_stable(spark):
    df = spark.range(1000).select(F.concat(F.lit("e"), "id").alias("id"))
    one = {r["id"] for r in charts.marker_sample(df, 50).collect()}
    two = {r["id"] for r in charts.marker_sample(df.repartition(7), 50).collect()}
    assert one == two and len(one) == 50


def test_augment_repeats_exactly(spark):
    df = events(spark, [(f"e{i}", i / 10, 100 + i / 10, 3 + i / 50, float(i)) for i in range(50)])
    a = sorted(map(tuple, augment.augment(df, 3).collect()))
    b = sorted(map(tuple, augment.augment(df.repartition(5), 3).collect()))
    assert [x[0] for x in a] == [x[0] for x in b] and len(a) == 150
    assert all(x[1:] == pytest.approx(y[1:], abs=1e-12) for x, y in zip(a, b))
    assert augment.copies_for_size(10, 64) == 7 and augment.copies_for_size(10, 64, 3) == 3


def test_median_of_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert stats.approximate_medians(df, ["a", "b"]).first().asDict() == {"a": 0.0, "b": 1.0}


def test_dominant_key_is_split_among_many_heavy_ones(spark, monkeypatch):
    """Fifty heavy keys, one with most of the rows: the dominant one is salted whatever the limit of small sides."""
    monkeypatch.setattr(skew, "HEAVY_KEYS", 20)
    left = spark.range(8000).select(F.when(F.col("id") % 4 > 0, 0).otherwise(F.col("id") % 50 + 1).alias("k"), F.col("id").alias("v"))
    right = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    heavy = skew.heavy_keys(left, ["k"], rows_per_split=10)
    found = {r["k"]: r["_splits"] for r in heavy.collect()}
    assert 0 < len(found) < 20 and found[0] == 600
    joined = skew.balanced_join(left, right, ["k"], "inner", ["v"], limit=10, rows_per_split=10)
    assert "_salt" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert joined.count() == 8000 and joined.filter("w <> 2 * k").count() == 0


def test_default_rules_have_no_ceiling(spark):
    rows = spark.range(300_000).select(
        F.col("id").cast("string").alias("id"), F.lit(5.0).alias("magnitude"), F.lit(0.0).alias("latitude"),
        F.lit(100.0).alias("longitude"), F.lit(10.0).alias("depth"),
    )
    assert validate.report(validate.check(rows, validate.raw_rules()), strict=True).first()["success"]
    assert not validate.check(rows, validate.raw_rules(max_rows=100_000)).first()["passed"]


def test_one_scan_for_the_overall_status(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(5.0, 1.0, 2.0, 3.0, "z", 2020, 1)], "magnitude double, latitude double, longitude double, depth double, geographic_zone string, year int, month int").write.parquet(path)
    status = validate.overall_status(spark.read.parquet(path))
    assert status._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r["test"]: r["status"] for r in status.collect()} == {
        "record_count": "PASS", "magnitude_quality": "PASS", "latitude_quality": "PASS", "longitude_quality": "PASS", "depth_quality": "PASS",
        "magnitude_range": "PASS", "geographic_distribution": "PASS", "temporal_coverage": "FAIL", "overall": "FAIL",
    }
