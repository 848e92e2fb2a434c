"""Jobs: streaming, splits, metrics, writers."""

import gzip
import json
from collections import Counter
from itertools import product
from types import SimpleNamespace

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Observation
from pyspark.sql import functions as F

from suite import base, load
from suite.check import compare
from tremor.learning import metrics, models, registry, split
from tremor.sources import files, sinks
from tremor.schemas import FEATURE
from tremor.operators import validate
from tremor.streaming.ingest import read_feature_stream, start_ingest, transform_features
from tremor.streaming.stateful import append_available, daily_windows, without_repeats


def feature(name, mag, coordinates):
    return {"id": name, "properties": {"mag": mag, "place": "here", "time": 1_700_000_000_123}, "geometry": {"coordinates": coordinates}}


def test_stream_equals_batch(spark, tmp_path):
    records = [feature("full", 5.0, [100.0, -3.0, 12.5]), feature("short", 4.0, [101.0, -4.0]), feature("none", None, [1.0, 2.0, 3.0]),
               feature("pole", 5.0, [0.0, 91.0, 1.0])]
    landing = tmp_path / "landing"
    landing.mkdir()
    for i, record in enumerate(records):
        (landing / f"{i}.json").write_text(json.dumps(record))
    stream = transform_features(read_feature_stream(spark, str(landing), 1))
    start_ingest(stream, str(tmp_path / "progress"), str(tmp_path / "out"), available_now=True).awaitTermination()
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out")).drop("processed_at")
    batch = transform_features(spark.read.schema(FEATURE).json(str(landing))).drop("processed_at")
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect()))
    assert {r["id"]: r["depth"] for r in got.collect()} == {"full": 12.5, "short": None}


def test_split_is_exact_and_repeatable(spark):
    rows = [(f"e{i:04d}", "big" if i % 5 else "small") for i in range(1003)]
    df = spark.createDataFrame(rows, "id string, zone string")
    one = {r["id"] for r in split.stratified_split(df, "zone").filter("is_test").collect()}
    two = {r["id"] for r in split.stratified_split(df.repartition(7), "zone").filter("is_test").collect()}
    sizes, zone = Counter(z for _, z in rows), dict(rows)
    assert one == two and Counter(zone[i] for i in one) == {z: round(n * 0.2) for z, n in sizes.items()}
    folds = Counter((r["zone"], r["fold"]) for r in split.stratified_folds(df, "zone", 3).collect())
    assert all(n in (sizes[z] // 3, sizes[z] // 3 + 1) for (z, _), n in folds.items()) and len(folds) == 6


def test_weighted_metrics(spark):
    pairs = [("a", "a")] * 6 + [("a", "b")] * 2 + [("b", "b")] + [("b", "c")]
    df = spark.createDataFrame(pairs, "label string, prediction string")
    got = metrics.weighted_metrics(df).first()
    assert got["accuracy"] == pytest.approx(0.7) and got["recall"] == pytest.approx(0.7)
    assert got["precision"] == pytest.approx((8 * 1.0 + 2 * (1 / 3)) / 10)
    assert got["f1_score"] == pytest.approx((8 * (1.5 / 1.75) + 2 * 0.4) / 10)
    matrix = {r["label"]: (r["a"], r["b"], r["c"]) for r in metrics.confusion_matrix(df, ["a", "b", "c"]).collect()}
    assert matrix == {"a": (6, 2, 0), "b": (0, 1, 1)}


def test_typed_load_keeps_rejects(spark):
    df = spark.createDataFrame([("a", "1.5", "0", "1", "1700000000123", "3"), ("b", "x", "0", "1", "0", "3"), ("c", "2", "0", "1", None, "many")],
                               "id string, magnitude string, latitude string, longitude string, time string, significance string")
    good, bad = files.load_raw(df)
    assert [(r["id"], r["magnitude"], str(r["time"])[:19], r["significance"]) for r in good.collect()] == [("a", 1.5, "2023-11-14 22:13:20", 3)]
    assert sorted(r["id"] for r in bad.collect()) == ["b", "c"]


def test_unknown_format(spark):
    with pytest.raises(ValueError):
        files.read_catalog(spark, "catalog.xls")


def test_database_fallback(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0, [1])], "id string, magnitude double, extra array<int>")
    assert not sinks.write_jdbc(df, "t", "jdbc:none://nowhere", {}, fallback=str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).columns == ["id", "magnitude", "extra"]
    with pytest.raises(Exception):
        sinks.write_jdbc(df, "t", "jdbc:none://nowhere", {})


def test_write_jdbc_raises_errors_of_the_plan(spark, tmp_path):
    broken = spark.range(3).select(F.raise_error(F.lit("broken plan")).cast("string").alias("id"))
    with pytest.raises(Exception, match="broken plan"):
        sinks.write_jdbc(broken, "t", "jdbc:none://nowhere", {}, fallback=str(tmp_path / "t"))


def test_failed_refresh_keeps_the_old_version(spark, tmp_path):
    path = str(tmp_path)
    sinks.refresh_tables({"a": spark.range(5), "b": spark.range(2)}, path)
    broken = spark.range(3).select(F.raise_error(F.lit("crash")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="crash"):
        sinks.refresh_tables({"a": spark.range(9), "b": broken}, path)
    assert (sinks.read_stored(spark, path, "a").count(), sinks.read_stored(spark, path, "b").count()) == (5, 2)
    sinks.refresh_tables({"a": sinks.read_stored(spark, path, "a").filter("id > 1")}, path)
    assert sinks.read_stored(spark, path, "a").count() == 3


def test_header_with_a_repeated_name_raises(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,magnitude,id\n1,2,3\n")
    with pytest.raises(ValueError, match="twice"):
        files.read_csv_by_name(spark, str(tmp_path / "t.csv"))


def zones(spark, n=240):
    rows = [(f"e{i:03d}", ("Low", "High", "Extreme")[(i % 7 > 3) + (i % 11 > 8)], float(i % 7) if i % 5 else None, float(i % 11)) for i in range(n)]
    return spark.createDataFrame(rows, "id string, risk_zone string, a double, b double")


def test_forest_prefixes(spark):
    """The first prefix is the forest of its size; prefixes count every row once; votes of blocks add up to the forest's."""
    (train, valid), *others = models.fold_tables(zones(spark), ("a", "b"), 3)
    assert len(others) == 2 and valid.count() + train.count() == 240
    setting = {"maxDepth": 3, "minInstancesPerNode": 1, "featureSubsetStrategy": "sqrt"}
    counts = models.forest_prefixes(train, valid, [7, 3], setting).collect()
    assert {n: sum(r["n"] for r in counts if r["numTrees"] == n) for n in (3, 7)} == {3: valid.count(), 7: valid.count()}

    def forest(n, seed):
        return models.RandomForestClassifier(numTrees=n, seed=seed, **setting).fit(train).transform(valid)

    def as_counts(df):
        return Counter((r["label"], r["prediction"]) for r in df.collect())

    assert as_counts(forest(3, models.SEED)) == {(r["label"], r["prediction"]): r["n"] for r in counts if r["numTrees"] == 3}
    one, two = (forest(n, models.SEED + k).select("features", "label", "rawPrediction").collect() for k, n in enumerate((3, 4)))
    votes = {}
    for r in [*one, *two]:
        key = (tuple(r["features"]), r["label"])
        votes[key] = votes.get(key, 0) + r["rawPrediction"].toArray()
    times = Counter((tuple(r["features"]), r["label"]) for r in one)
    want = Counter()
    for (x, label), v in votes.items():
        want[(label, float(v.argmax()))] += times[(x, label)]
    assert want == {(r["label"], r["prediction"]): r["n"] for r in counts if r["numTrees"] == 7}


def test_medians_of_a_fold_come_from_its_training_rows(spark):
    """One outlying value moves the medians of the folds that train on it, not of the one that validates on it."""
    rows = zones(spark, 30).withColumn("a", F.when(F.col("id") < "e004", F.col("a")))
    for train, valid in models.fold_tables(rows, ("a", "b"), 3):
        seen = train.unionAll(valid).select("features").collect()
        assert len(seen) == 30 and all(x == x for r in seen for x in r["features"])


def test_search_names_one_best_setting(spark):
    rows = zones(spark)
    found = models.search(rows, ("a", "b"), {"numTrees": [2, 5], "maxDepth": [1, 4], "minInstancesPerNode": [1], "featureSubsetStrategy": ["all"]}, 3)
    got = found.collect()
    assert len(got) == 4 and sum(r["best"] for r in got) == 1
    assert max(r["f1_weighted"] for r in got) == next(r["f1_weighted"] for r in got if r["best"])
    assert all(0 <= r["f1_lowest"] <= r["f1_weighted"] + 1e-12 <= r["f1_highest"] + 2e-12 <= 1 + 3e-12 for r in got)
    model = models.best_forest(rows, found, ("a", "b"))
    assert {r[0] for r in model.transform(rows).select("predicted_zone").distinct().collect()} <= {"Low", "High", "Extreme"}


def at(name, day, mag=5.0):
    return {"id": name, "properties": {"mag": mag, "place": "p", "time": 1_700_000_000_000 + int(day * 86_400_000)}, "geometry": {"coordinates": [1.0, 2.0, 3.0]}}


def test_stream_drops_repeats_and_late_records(spark, tmp_path):
    """Three runs over one checkpoint; the last finds nothing new, and what is committed is not written again."""
    landing = tmp_path / "landing"
    landing.mkdir()

    def run(name, *records):
        (landing / name).write_text("\n".join(map(json.dumps, records)))
        stream = without_repeats(transform_features(read_feature_stream(spark, str(landing))))
        return append_available(stream, str(tmp_path / "out"), str(tmp_path / "progress")), stream

    one, _ = run("1.json", at("a", 0), at("b", 9), at("b", 9), at("c", 10), {**at("no time", 1), "properties": {"mag": 5.0, "place": "p", "time": None}})
    two, _ = run("2.json", at("c", 10), at("old", 3), at("edge", 8.5), at("d", 11))
    three, stream = run("1.json")
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    assert sorted(r["id"] for r in got.collect()) == ["a", "b", "c", "d", "edge"]
    assert (one.records, one.late, two.records, two.late, three.records) == (5, 0, 4, 1, 0)


def test_stream_days_close_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    days = []
    for name, records in (("1", [at("a", 0, 4.0), at("b", 0.01, 6.0), at("c", 5)]), ("2", [at("late", 0), at("d", 5.01), at("e", 20)])):
        (landing / f"{name}.json").write_text("\n".join(map(json.dumps, records)))
        stream = daily_windows(transform_features(read_feature_stream(spark, str(landing))))
        append_available(stream, str(tmp_path / "out"), str(tmp_path / "progress"))
        rows = spark.read.schema(stream.schema).parquet(str(tmp_path / "out")).orderBy("date").collect()
        days.append([(str(r["date"]), r["earthquake_count"], r["avg_magnitude"], r["max_magnitude"]) for r in rows])
    assert days == [[("2023-11-14", 2, 5.0, 6.0)], [("2023-11-14", 2, 5.0, 6.0), ("2023-11-19", 2, 5.0, 5.0)]]


def test_a_writer_that_loses_rows_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "stored")
    assert [tuple(r) for r in sinks.refresh_tables({"a": spark.range(5), "none": spark.range(0)}, path).collect()] == [("a", 5), ("none", 0)]
    with pytest.raises(ValueError, match="9 rows were handed to the writer, 8 are in the files"):
        sinks.refresh_tables({"a": spark.range(9)}, path, write=lambda df, p: df.filter("id <> 4").write.parquet(p))
    assert sinks.read_stored(spark, path, "a").count() == 5


def test_reports_run_whole(spark, tmp_path):
    """A value that only the whole result needs fails its report; an empty report gets its fallback row."""
    broken = F.when(F.col("id") == 3, F.raise_error(F.lit("bad value"))).otherwise(F.lit("x"))
    suite = {"sound": lambda: spark.range(4), "broken": lambda: spark.range(9).withColumn("v", broken), "empty": lambda: spark.range(4).filter("id > 9")}
    got = validate.suite_summary(spark, suite, str(tmp_path), {"empty": {"id": F.lit(-1)}})
    assert {r["query"]: (r["status"], r["row_count"]) for r in got.collect()} == {"sound": ("SUCCESS", 4), "broken": ("FAILED", 0), "empty": ("SUCCESS", 1)}
    assert [r[0] for r in spark.read.parquet(str(tmp_path / "empty")).collect()] == [-1]


def test_months_change_alone(spark, tmp_path):
    path = str(tmp_path / "months")
    rows = spark.range(90).select("id", F.timestamp_add("DAY", F.col("id").cast("int"), F.lit("2024-01-01").cast("timestamp")).alias("datetime_local"), F.lit(1.0).alias("depth"))
    for batch in ("one", "one", "two"):
        sinks.append_by_month(rows, path, batch=batch)
    assert sinks.read_months(spark, path).count() == 180

    def modified():
        return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "months").rglob("*.parquet")}

    before = modified()
    may = F.col("id") >= 31 + 29
    for _ in range(2):
        counts = sinks.change_months(spark, path, may & (F.col("depth") == 1), lambda df: df.withColumn("depth", F.when(may, 2.0).otherwise(F.col("depth"))))
    assert counts.count() == 0 and {p for p, t in before.items() if modified().get(p) == t} == {p for p in before if "2024-03" not in p}
    counts = sinks.change_months(spark, path, F.col("month_batch") == "2024-02", lambda df: df.filter("batch = 'two'"))
    assert sorted(map(tuple, counts.collect())) == [("2024-02", "one", 29, 0), ("2024-02", "two", 29, 29)]
    got = sinks.read_months(spark, path).groupBy("month_batch", "batch", "depth").count().collect()
    assert sorted(map(tuple, got)) == [("2024-01", "one", 1.0, 31), ("2024-01", "two", 1.0, 31), ("2024-02", "two", 1.0, 29), ("2024-03", "one", 2.0, 30), ("2024-03", "two", 2.0, 30)]


def test_csv_headers(spark, tmp_path):
    """Headers with quoted line breaks and beyond the first bytes, packed, empty and hidden files, folders in folders."""
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.csv").write_text('id,"na\nme"\n1,"x ""y""\nz"\n')
    (tmp_path / "in" / "deep" / "b.csv").write_text("\ufeffid,other\n2,é\n")
    (tmp_path / "in" / "c.csv.gz").write_bytes(gzip.compress(b"other,id\nq,3\n"))
    (tmp_path / "in" / "empty.csv").write_text("")
    (tmp_path / "in" / "_SUCCESS").write_text("no,header")
    got = files.read_csv_by_name(spark, str(tmp_path / "in"), line_breaks=True)
    assert sorted((r["id"], r["na\nme"], r["other"]) for r in got.collect()) == [("1", 'x "y"\nz', None), ("2", None, "é"), ("3", None, "q")]
    wide = ["id", *(f"column_{i}" for i in range(1000))]
    (tmp_path / "wide.csv").write_text(",".join(wide) + "\n" + ",".join(map(str, range(1001))) + "\n")
    row = files.read_csv_by_name(spark, str(tmp_path / "wide.csv")).first()
    assert row["id"] == "0" and row["column_999"] == "1000"
    (tmp_path / "only.csv").write_text("id")
    assert files.read_csv_by_name(spark, str(tmp_path / "only.csv")).columns == ["id"]
    with pytest.raises(FileNotFoundError):
        files.read_csv_by_name(spark, str(tmp_path / "missing.csv"))
    with pytest.raises(ValueError, match="no header"):
        files.read_csv_by_name(spark, str(tmp_path / "in" / "empty.csv"))


def test_silhouettes_are_the_evaluators(spark):
    """All clusterings at once score as one evaluator job each does, also with a point alone in its cluster."""
    rows = spark.range(400).select(F.array(*[F.randn(seed) + F.col("id") % 3 * 4 for seed in (1, 2, 3)]).alias("v"))
    rows = rows.unionByName(spark.range(1).select(F.array(*[F.lit(90.0)] * 3).alias("v")))
    data = rows.select(array_to_vector("v").alias("f")).cache()
    best, scores = models.choose_k_means(data, range(2, 6), "f")
    got = {r["k"]: r["silhouette"] for r in scores.collect()}
    assert sorted(got) == [2, 3, 4, 5]
    evaluator = ClusteringEvaluator(featuresCol="f", predictionCol="p")
    for k, value in got.items():
        fitted = KMeans(k=k, featuresCol="f", predictionCol="p", seed=models.SEED).fit(data)
        assert evaluator.evaluate(fitted.transform(data)) == pytest.approx(value, abs=1e-9)
    assert best.summary.k == max(got, key=lambda k: (got[k], -k)) and best.getPredictionCol() == "earthquake_cluster"
    alone = data.withColumn("one", F.lit(0))
    assert [tuple(r) for r in models.silhouettes(alone, {1: "one"}, "f").collect()] == [(1, 0.0)]
    assert models.silhouettes(alone.limit(0), {1: "one"}, "f").count() == 0


def test_k_means_keeps_vectors_on_disk(spark, monkeypatch):
    """The fits hold no vectors in the memory for storage, and the scores need no Python workers."""
    data = spark.range(300).select(array_to_vector(F.array(F.randn(1) + F.col("id") % 3 * 4, F.randn(2))).alias("f"))
    before = {i.id() for i in spark.sparkContext._jsc.sc().getRDDStorageInfo()}
    seen, plans, scored = [], [], models.silhouettes

    def watched(*arguments):
        seen.extend(i for i in spark.sparkContext._jsc.sc().getRDDStorageInfo() if i.id() not in before)
        found = scored(*arguments)
        plans.append(found._jdf.queryExecution().toString())
        return found

    monkeypatch.setattr(models, "silhouettes", watched)
    best, scores = models.choose_k_means(data, range(2, 4), "f")
    assert seen and not any(i.memSize() for i in seen) and any(i.diskSize() for i in seen)
    assert best.getSolver() == "row" and not any(x in plans[0] for x in ("InArrow", "ExistingRDD")) and scores.count() == 2


def test_silhouettes_of_equal_rows(spark):
    """Rows that are all equal make one cluster, whatever k is asked for."""
    data = spark.range(20).select(array_to_vector(F.array(F.lit(1.0), F.lit(2.0))).alias("f"))
    best, scores = models.choose_k_means(data, range(2, 4), "f")
    assert sorted(map(tuple, scores.collect())) == [(2, 0.0), (3, 0.0)]
    assert [tuple(r) for r in best.transform(data).groupBy("earthquake_cluster").count().collect()] == [(0, 20)]


def test_models_of_a_single_class(spark):
    """A catalog that forms one cluster has one risk zone; both models know that zone and nothing else."""
    rows = spark.range(40).select(
        F.concat(F.lit("e"), "id").alias("id"), F.lit("Extreme").alias("risk_zone"), (F.col("id") % 5 == 0).alias("is_test"),
        *[(F.col("id") * (k + 1) % 7).cast("double").alias(x) for k, x in enumerate(models.BASIC_FEATURES)])
    assert not models.trainable(rows).first()["trainable"]
    fitted, found = models.compare_models(rows, trees=2)
    assert {(r["model_name"], r["training_samples"], r["accuracy"]) for r in found.collect()} == {
        ("RandomForest", 32, 1.0), ("LogisticRegression", 32, 1.0)}
    for model in fitted.values():
        assert [tuple(r) for r in model.transform(rows).groupBy("predicted_zone").count().collect()] == [("Extreme", 40)]
    shares = models.feature_importances(spark, fitted["RandomForest"]).collect()
    assert len(shares) == len(models.BASIC_FEATURES) and all(r["importance"] == 0 for r in shares)
    with pytest.raises(ValueError):
        models.compare_models(rows.limit(0))


def test_models_of_two_classes_after_an_observation(spark):
    """A session that has seen an observation cannot be sent to tasks; models must not hold it."""
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    rows = spark.range(60).select(
        F.concat(F.lit("e"), "id").alias("id"), F.when(F.col("id") % 2 == 0, "Low").otherwise("High").alias("risk_zone"),
        (F.col("id") % 5 == 0).alias("is_test"), *[(F.col("id") % 2 + k).cast("double").alias(x) for k, x in enumerate(models.BASIC_FEATURES)])
    fitted, _ = models.compare_models(rows, trees=2)
    for model in fitted.values():
        assert {tuple(r) for r in model.transform(rows).groupBy("predicted_zone").count().collect()} == {("Low", 30), ("High", 30)}
    grid = {"numTrees": [1, 2], "maxDepth": [1], "minInstancesPerNode": [1], "featureSubsetStrategy": ["all"]}
    found = models.search(rows, models.BASIC_FEATURES, grid, 2)
    assert [r["f1_weighted"] for r in found.collect()] == [1.0, 1.0]
    best = models.best_forest(rows, found, models.BASIC_FEATURES)
    assert best.transform(rows).filter("predicted_zone = risk_zone").count() == 60


def test_registered_search_has_every_setting(spark, monkeypatch):
    """The query asks for the whole default grid over five folds, and its SQL lists all 81 settings."""
    import duckdb

    columns = ("latitude", "longitude", "magnitude", "depth", "spatial_density", "hazard_score")
    rows = spark.range(3).select(F.concat(F.lit("e"), "id").alias("id"), F.lit("Low").alias("risk_zone"), F.lit(False).alias("is_test"),
                                 *[F.col("id").cast("double").alias(x) for x in columns])
    asked = []

    def watched(rows, features=models.EXTENDED_FEATURES, grid=None, folds=5, parallelism=None):
        asked.append(({**models.GRID, **(grid or {})}, folds))
        found = [(*x, 0.5, 0.25, 0.75, i == 0) for i, x in enumerate(product(*asked[0][0].values()))]
        return spark.createDataFrame(found, "numTrees int, maxDepth int, minInstancesPerNode int, featureSubsetStrategy string, f1_weighted double, f1_lowest double, f1_highest double, best boolean")

    monkeypatch.setattr(models, "search", watched)
    monkeypatch.setattr(base, "tables", lambda session, folder: SimpleNamespace(training=rows))
    queries, oracles = load()
    got = queries["l11_grid_search"](spark, "")
    assert asked == [(models.GRID, 5)] and got.count() == 81
    assert compare(got, duckdb.connect(), oracles["l11_grid_search"]) == ""


def test_equal_forests_are_grown_once(spark, monkeypatch):
    """Strategies that draw the same number of features share forests; their scores are those of a search of their own."""
    rows = spark.range(90).select(
        F.concat(F.lit("e"), "id").alias("id"), F.when(F.xxhash64("id") % 3 == 0, "Low").otherwise("High").alias("risk_zone"),
        *[(F.col("id") * (2 * k + 3) % 17).cast("double").alias(x) for k, x in enumerate(models.EXTENDED_FEATURES)])
    grid = {"numTrees": [2, 4], "maxDepth": [3], "minInstancesPerNode": [1], "featureSubsetStrategy": ["sqrt", "log2", "all"]}
    grown, prefixes = [], models.forest_prefixes
    monkeypatch.setattr(models, "forest_prefixes", lambda *a: grown.append(a[3]["featureSubsetStrategy"]) or prefixes(*a))
    assert [models.drawn(x, 14) for x in grid["featureSubsetStrategy"]] == [4, 4, 14]
    found = models.search(rows, grid=grid, folds=2)
    assert Counter(grown) == {"sqrt": 2, "all": 2} and found.count() == 6
    alone = models.search(rows, grid={**grid, "featureSubsetStrategy": ["log2"]}, folds=2)
    assert Counter(grown) == {"sqrt": 2, "all": 2, "log2": 2}
    scores = [{r["numTrees"]: r["f1_weighted"] for r in x.filter("featureSubsetStrategy = 'log2'").collect()} for x in (found, alone)]
    assert scores[0] == pytest.approx(scores[1], abs=1e-12) and 0 < min(scores[0].values()) < 1


def test_registry_keeps_every_run(spark, tmp_path):
    path, data = str(tmp_path / "registry"), spark.range(3)
    assert registry.registered(spark, path).count() == 0 and registry.current_model(spark, path) is None
    fitted = {n: Pipeline(stages=[VectorAssembler(inputCols=["id"], outputCol=f"by_{n}")]).fit(data) for n in ("a", "b")}

    def scores(**f1):
        return spark.createDataFrame(
            [(n, 0.5, 0.5, 0.5, v, 7) for n, v in f1.items()], "model_name string, accuracy double, precision double, recall double, f1_score double, training_samples int"
        )

    first = registry.register(fitted, scores(a=0.25, b=0.75), path)
    assert "by_b" in registry.current_model(spark, path).transform(data).columns
    with pytest.raises(ValueError, match="do not belong"):
        registry.register(fitted, scores(a=0.9), path)
    second = registry.register(fitted, scores(a=0.5, b=0.5), path)
    stored = registry.registered(spark, path)
    assert Counter(r["run"] for r in stored.collect()) == {first: 2, second: 2}
    assert {(r["model_name"], r["run"], r["training_samples"]) for r in registry.latest(stored).collect()} == {("a", second, 7), ("b", second, 7)}
    assert "by_a" in registry.current_model(spark, path).transform(data).columns
