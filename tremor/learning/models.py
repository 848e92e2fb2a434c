"""Classifiers for risk zones and K-Means over scaled features."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import IndexToString, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremor.functions.classify import cluster_risk
from tremor.functions.scores import BASIC_FEATURES, EXTENDED_FEATURES, with_basic_features
from tremor.learning.metrics import grouped_metrics, weighted_metrics, with_gap
from tremor.learning.prepare import imputer
from tremor.learning.split import stratified_folds, stratified_split
from tremor.operators.filters import labelled
from tremor.workspace import constants, materialise, new_path, settled

SEED = 42


def training_rows(processed: DataFrame, clusters: DataFrame) -> DataFrame:
    """Labelled events: the inner join of events and clusters on the event id."""
    c = labelled(clusters).select("id", "risk_zone", "cluster_size", F.col("avg_magnitude").alias("cluster_avg_magnitude"))
    return processed.join(c, "id")


def trainable(rows: DataFrame) -> DataFrame:
    """One row: the number of samples and classes, and whether training makes sense."""
    return rows.agg(F.count(F.lit(1)).alias("samples"), F.countDistinct("risk_zone").alias("classes")).withColumn(
        "trainable", (F.col("samples") > 0) & (F.col("classes") >= 2)
    )


def label_indexer(column: str = "risk_zone") -> StringIndexer:
    """Labels are numbered alphabetically."""
    return StringIndexer(inputCol=column, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="error")


def encode_labels(rows: DataFrame, column: str = "risk_zone") -> DataFrame:
    return label_indexer(column).fit(rows).transform(rows)


def with_class_weights(rows: DataFrame) -> DataFrame:
    """Weight n / (classes * class size). The class table is as small as the set of risk zones."""
    sizes = rows.groupBy("label").agg(F.count(F.lit(1)).alias("_size"))
    whole = constants(sizes.agg(F.sum("_size").alias("n"), F.count(F.lit(1)).alias("k")))
    weights = sizes.withColumn("weight", whole["n"] / (whole["k"] * F.col("_size")))
    return rows.join(F.broadcast(weights.drop("_size")), "label")


def random_forest(trees: int = 100, depth: int = 8, min_leaf: int = 3, weighted: bool = True) -> RandomForestClassifier:
    model = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, seed=SEED
    )
    return model.setWeightCol("weight") if weighted else model


def logistic_regression(samples: int, c: float = 0.5) -> LogisticRegression:
    """Multinomial, balanced. The penalty of ``c`` on summed losses is 1/(c*n) on mean losses."""
    return LogisticRegression(
        featuresCol="features", labelCol="label", family="multinomial", maxIter=1000, regParam=1.0 / (c * samples),
        elasticNetParam=0.0, standardization=False, weightCol="weight",
    )


def vector_stages(features: tuple[str, ...]) -> list:
    """Medians of the training rows for missing features, vector, scaling; all of it is saved with the model."""
    return [
        imputer(list(features)),
        VectorAssembler(inputCols=list(features), outputCol="features_raw", handleInvalid="error"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
    ]


def prepare_training(processed: DataFrame, clusters: DataFrame) -> DataFrame:
    """Labelled, featured and split rows as a written table. Missing features are filled by the model itself."""
    rows = with_basic_features(training_rows(processed, clusters))
    return materialise(stratified_split(materialise(rows, "training-rows"), "risk_zone", 0.2, "id", SEED), "training")


def detached(model: PipelineModel, rows: DataFrame) -> PipelineModel:
    """The fitted model read back from a scratch folder, without its training summary.

    The summary of a model of one or two classes holds the session, which cannot be sent to tasks once it has seen an
    observation (as table refreshes make); the model could not be applied then.
    """
    path = new_path(rows.sparkSession, "fitted-model")
    save(model, path)
    return load(path)


def compare_models(prepared: DataFrame, trees: int = 100) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Fit both classifiers; (models, one row of metrics per model).

    Rows of a single class, as a dense catalog that forms one cluster gives, make models that know this class only. Whether
    such models are worth keeping is for the caller to say (:func:`trainable`).
    """
    if prepared.isEmpty():
        raise ValueError("training needs rows")
    indexer = label_indexer().fit(prepared)
    indexed = indexer.transform(prepared)
    train = materialise(with_class_weights(indexed.filter(~F.col("is_test"))), "train")
    test = materialise(indexed.filter("is_test"), "test")
    samples = train.count()
    fitted, rows = {}, None
    for name, estimator in {"RandomForest": random_forest(trees), "LogisticRegression": logistic_regression(samples)}.items():
        back = IndexToString(inputCol="prediction", outputCol="predicted_zone", labels=indexer.labels)
        model = detached(Pipeline(stages=[*vector_stages(BASIC_FEATURES), estimator, back]).fit(train), train)
        fitted[name] = model
        scored = with_gap(
            weighted_metrics(materialise(model.transform(test).select("label", "prediction"), "scored")),
            weighted_metrics(materialise(model.transform(train).select("label", "prediction"), "scored")),
        )
        scored = scored.select(F.lit(name).alias("model_name"), "*", F.lit(samples).alias("training_samples"))
        rows = scored if rows is None else rows.unionByName(scored)
    return fitted, materialise(rows, "comparison")


def best_model(comparison: DataFrame) -> DataFrame:
    """The metadata row of the model with the highest F1."""
    best = comparison.agg(F.max_by(F.struct(*comparison.columns), F.struct("f1_score", "model_name")).alias("b"))
    return best.select(
        "b.model_name", F.col("b.model_name").alias("model_type"), "b.accuracy", F.col("b.precision").alias("precision_score"),
        F.col("b.recall").alias("recall_score"), "b.f1_score", "b.training_samples",
    )


# The default grid: 81 settings.
GRID = {"numTrees": [100, 200, 300], "maxDepth": [10, 20, 30], "minInstancesPerNode": [1, 2, 4], "featureSubsetStrategy": ["sqrt", "log2", "all"]}


def fold_tables(rows: DataFrame, features: tuple[str, ...], folds: int) -> list[tuple[DataFrame, DataFrame]]:
    """(training, validation) rows with ``label`` and ``features`` per fold, written; medians come from the training rows alone."""
    folded = materialise(stratified_folds(encode_labels(rows), "risk_zone", folds, "id", SEED), "folds")
    prepare = Pipeline(stages=[imputer(list(features)), VectorAssembler(inputCols=list(features), outputCol="features")])
    made = []
    for k in range(folds):
        train, valid = folded.filter(F.col("fold") != k), folded.filter(F.col("fold") == k)
        filled = prepare.fit(train)
        made.append(tuple(materialise(filled.transform(x).select("label", "features"), "fold") for x in (train, valid)))
    return made


def forest_prefixes(train: DataFrame, valid: DataFrame, trees: list[int], setting: dict) -> DataFrame:
    """(numTrees, label, prediction, n): predictions of the first so many trees of one forest, counted.

    The forest grows in blocks, each with its own seed. What a forest votes is the sum of what its blocks vote, so every
    prefix is scored without growing its trees again. The votes are written after every block, which lets go of its trees.
    """
    votes, prefixes, grown = valid, [], 0
    for block, upto in enumerate(sorted(set(trees))):
        forest = RandomForestClassifier(
            featuresCol="features", labelCol="label", numTrees=upto - grown, seed=SEED + block, cacheNodeIds=True,
            rawPredictionCol="raw", probabilityCol="probability", predictionCol="prediction", **setting,
        )
        # A copy of a forest has no training summary; see :func:`detached`.
        scored = forest.fit(train).copy().transform(votes).withColumn("own", vector_to_array("raw"))
        scored = scored.withColumn("sum", F.zip_with("sum", "own", lambda a, b: a + b) if grown else F.col("own"))
        scored = scored.withColumn(f"prediction_{upto}", (F.array_position("sum", F.array_max("sum")) - 1).cast("double"))
        votes = materialise(scored.select("label", "features", "sum", *prefixes, f"prediction_{upto}"), "votes")
        prefixes.append(f"prediction_{upto}")
        grown = upto
    each = votes.select("label", F.explode(F.array(*[
        F.struct(F.lit(int(p.split("_")[1])).alias("numTrees"), F.col(p).alias("prediction")) for p in prefixes
    ])).alias("p")).select("p.numTrees", "label", "p.prediction")
    return each.groupBy("numTrees", "label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def drawn(strategy: str, features: int) -> int | str:
    """How many of the features MLlib draws at every node; another strategy stands for itself."""
    counts = {"all": features, "sqrt": math.ceil(math.sqrt(features)), "log2": max(1, math.ceil(math.log(features) / math.log(2)))}
    return counts.get(strategy, strategy)


def search(
    rows: DataFrame, features: tuple[str, ...] = EXTENDED_FEATURES, grid: dict[str, list] | None = None,
    folds: int = 5, parallelism: int | None = None,
) -> DataFrame:
    """Grid search by weighted F1 over exact stratified folds: one row per setting with f1_weighted, f1_lowest, f1_highest, best.

    ``rows`` has ``risk_zone`` and ``id``. Medians are those of each fold's training rows. Settings that differ in the
    number of trees alone share one forest (:func:`forest_prefixes`), and so do strategies that draw the same number of
    features (:func:`drawn`), whose forests are equal: four of 14 by ``sqrt`` and by ``log2``. The default grid's 81 settings
    take 18 forests of 300 trees per fold then. Its depth of 30, the deepest MLlib grows, stands for trees of unlimited
    depth. Of equal scores the smaller forest is best. As many forests grow at once as the cores take, two at least: the rows
    of a small table are in one task.
    """
    spark = rows.sparkSession
    axes = {**GRID, **(grid or {})}
    trees = axes.pop("numTrees")
    alike: dict[tuple, list[dict]] = {}
    for values in product(*axes.values()):
        setting = dict(zip(axes, values))
        alike.setdefault((*values[:-1], drawn(setting["featureSubsetStrategy"], len(features))), []).append(setting)
    groups = list(alike.values())
    tables = fold_tables(rows, features, folds)
    if parallelism is None:
        parallelism = max(2, spark.sparkContext.defaultParallelism // max(1, tables[0][0].rdd.getNumPartitions()))

    def counted(job: tuple[int, int]) -> list[tuple]:
        settings, fold = groups[job[0]], job[1]
        votes = settled(spark, lambda: forest_prefixes(*tables[fold], trees, settings[0]), "votes-counted").collect()
        return [(*setting.values(), fold, *row) for setting in settings for row in votes]

    with ThreadPoolExecutor(parallelism) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(counted), product(range(len(groups)), range(folds))))
    kinds = "maxDepth int, minInstancesPerNode int, featureSubsetStrategy string, fold int, numTrees int, label double, prediction double, n long"
    counts = spark.createDataFrame([row for job in found for row in job], kinds)
    each = grouped_metrics(counts, [*GRID, "fold"])
    scores = each.groupBy(*GRID).agg(
        F.avg("f1_score").alias("f1_weighted"), F.min("f1_score").alias("f1_lowest"), F.max("f1_score").alias("f1_highest")
    )
    first = Window.orderBy(F.desc("f1_weighted"), "numTrees", "maxDepth", F.desc("minInstancesPerNode"), "featureSubsetStrategy")
    # The grid is as long as the product of its axes: a few hundred rows, however many events there are.
    return materialise(scores.withColumn("best", F.row_number().over(first) == 1), "grid-scores")


def best_forest(rows: DataFrame, scores: DataFrame, features: tuple[str, ...] = EXTENDED_FEATURES) -> PipelineModel:
    """The pipeline of the best setting, fitted to all ``rows``; it fills missing features and names the zone."""
    setting = scores.filter("best").select(*GRID).first().asDict()
    indexer = label_indexer().fit(rows)
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", seed=SEED, cacheNodeIds=True, **setting)
    back = IndexToString(inputCol="prediction", outputCol="predicted_zone", labels=indexer.labels)
    assemble = VectorAssembler(inputCols=list(features), outputCol="features")
    return detached(Pipeline(stages=[imputer(list(features)), assemble, forest, back]).fit(indexer.transform(rows)), rows)


def feature_importances(spark, model: PipelineModel, features: tuple[str, ...] = BASIC_FEATURES) -> DataFrame:
    """(feature, importance) of the forest stage, one row per feature."""
    forest = next(s for s in model.stages if hasattr(s, "featureImportances"))
    values = [float(v) for v in forest.featureImportances.toArray()]
    return spark.createDataFrame(list(zip(features, values)), "feature string, importance double")


def top_features(importances: DataFrame, n: int = 5) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature").limit(n)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(clusters: DataFrame, processed: DataFrame, model: PipelineModel | None) -> DataFrame:
    """Clusters with ``risk_zone`` predicted per event and its probability.

    Without a model, and for events that are not in ``processed``, the seed rule on the cluster's strongest event
    gives the zone. A prediction depends on the event and the model alone, not on the batch it is scored in.
    """
    seed = cluster_risk(F.col("max_magnitude"))
    if model is None:
        return clusters.withColumns({"risk_zone": seed, "probability": F.lit(None).cast("double")})
    rows = with_basic_features(processed.join(clusters.select("id"), "id"))
    predicted = model.transform(rows).select(
        "id", F.col("predicted_zone").alias("_zone"), F.array_max(vector_to_array("probability")).alias("probability")
    )
    return clusters.join(predicted, "id", "left").withColumn("risk_zone", F.coalesce("_zone", seed)).drop("_zone")


def silhouettes(assigned: DataFrame, clusterings: dict[int, str], features: str) -> DataFrame:
    """(k, silhouette) of several clusterings of the same rows, by squared distance; ``clusterings`` maps k to its column.

    Each clustering is scored by the evaluator, whose two passes run in the JVM and keep a row per cluster: executors need
    no memory for Python workers. A point alone in its cluster scores 0, as does every point of a clustering with a single
    cluster. Without rows there is no result row.
    """
    marks = list(clusterings.values())
    ends = assigned.agg(*[f(c).cast("int") for c in marks for f in (F.min, F.max)]).first()
    found = []
    for i, (k, c) in enumerate(clusterings.items()):
        low, high = ends[2 * i], ends[2 * i + 1]
        if low is not None:
            one = ClusteringEvaluator(featuresCol=features, predictionCol=c)
            found.append((k, 0.0 if low == high else one.evaluate(assigned)))
    # Literals: local rows would be read by a Python worker.
    rows = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("silhouette")) for k, v in found])
    return assigned.sparkSession.range(0, 1, 1, 1).select(F.inline(rows.cast("array<struct<k:int,silhouette:double>>")))


def choose_k_means(vectors: DataFrame, ks=range(2, 11), features: str = "features_scaled") -> tuple[KMeansModel, DataFrame]:
    """(model, (k, silhouette) rows): the number of clusters with the best silhouette; of equal ones the smaller.

    The vectors are kept once, on the executors' disks, and the fits read them row by row: the block solver would keep a
    second copy, and both would fill the memory for storage.
    """
    data = vectors.select(features).persist(StorageLevel.DISK_ONLY)
    try:
        tried = {k: KMeans(k=k, featuresCol=features, predictionCol="earthquake_cluster", seed=SEED, solver="row").fit(data) for k in ks}
        assigned = data
        for k, model in tried.items():
            assigned = model.copy({model.predictionCol: f"cluster_{k}"}).transform(assigned)
        scores = materialise(silhouettes(assigned, {k: f"cluster_{k}" for k in tried}, features), "silhouettes")
    finally:
        data.unpersist()
    best = scores.orderBy(F.desc("silhouette"), "k").first()
    return tried[best["k"]], scores


def k_means_profile(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("earthquake_cluster").agg(
        F.count(F.lit(1)).alias("cluster_size"), F.avg("magnitude").alias("avg_magnitude"),
        F.avg("depth").alias("avg_depth"), F.avg("risk_score").alias("avg_risk_score"),
    )
