"""Feature pipelines, classifiers, metrics, K-Means."""

from __future__ import annotations


from pyspark.sql import functions as F

from suite.base import Tables, query, rounded
from suite.sql import CLUSTERS, EV, FEAT, PROC, r
from tremor.functions.scores import with_extended_features
from tremor.learning import metrics, models, prepare, split
from tremor.sources import sinks

c = F.col
_kept: dict = {}


def kept(t: Tables, name: str, make):
    """Compute a fitted model once per set of tables."""
    key = (id(t), name)
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def features(t: Tables):
    return kept(t, "features", lambda: prepare.fit_features(t.features))


def comparison(t: Tables):
    return kept(t, "comparison", lambda: models.compare_models(t.training))


def guesses(t: Tables):
    """A fixed rule as prediction, to check the metrics by value."""
    from tremor.functions.classify import cluster_risk

    rows = t.processed.join(t.clusters.select("id", "risk_zone"), "id")
    return rows.select(c("risk_zone").alias("label"), cluster_risk(c("magnitude")).alias("prediction"))


GUESS = """g AS (SELECT clus.risk_zone AS label, CASE WHEN magnitude>=6.5 THEN 'Extreme' WHEN magnitude>=5.5 THEN 'High' WHEN magnitude>=4.5 THEN 'Moderate' ELSE 'Low' END AS prediction FROM proc JOIN clus USING (id)),
 k AS (SELECT DISTINCT label AS class FROM g UNION SELECT DISTINCT prediction FROM g),
 pc AS (SELECT class, (SELECT count(*) FROM g WHERE label=class) AS support, (SELECT count(*) FROM g WHERE prediction=class) AS guessed, (SELECT count(*) FROM g WHERE prediction=class AND label=class) AS hit FROM k),
 rep AS (SELECT class, support, CASE WHEN guessed=0 THEN 0 ELSE hit/guessed END AS p, CASE WHEN support=0 THEN 0 ELSE hit/support END AS rc, hit FROM pc),
 rep2 AS (SELECT *, CASE WHEN p+rc=0 THEN 0 ELSE 2*p*rc/(p+rc) END AS f FROM rep)"""


@query("l1_median_imputation", f"WITH {EV}, h AS (SELECT id, CASE WHEN tsunami=0 THEN depth END AS depth, CASE WHEN alert IS NOT NULL THEN magnitude END AS magnitude FROM ev) SELECT id, {r('coalesce(depth, median(depth) OVER ())', 9)} AS depth, {r('coalesce(magnitude, median(magnitude) OVER ())', 9)} AS magnitude FROM h")
def _(t: Tables):
    holes = t.catalog.select("id", F.when(c("tsunami") == 0, c("depth")).alias("depth"), F.when(c("alert").isNotNull(), c("magnitude")).alias("magnitude"))
    return rounded(prepare.impute_medians(holes, ["depth", "magnitude"]), "depth", "magnitude", digits=9)


# The categories that vary in the test tables, in vector order after the numeric features.
VARYING = ["alert_standardized", "magnitude_category", "depth_category_detailed", "geographic_zone", "season"]
WIDTH = len(prepare.NUMERIC)
# Every numeric feature, and per category its values by frequency with their shares, a zero entry and the step to a one when scaled.
WHOLE = f"""{FEAT}, whole AS (SELECT *, sqrt(pow(longitude-140,2)+pow(latitude-35,2)) AS ring_of_fire_distance, 1.5::DOUBLE*magnitude+4.8::DOUBLE AS energy_release_log,
 magnitude * CASE geographic_zone WHEN 'indonesia' THEN 1000 WHEN 'japan' THEN 800 WHEN 'philippines' THEN 600 ELSE 200 END AS population_impact_estimate,
 CASE geographic_zone WHEN 'indonesia' THEN 0.95::DOUBLE WHEN 'japan' THEN 0.90::DOUBLE WHEN 'philippines' THEN 0.85::DOUBLE WHEN 'chile' THEN 0.80::DOUBLE ELSE 0.30::DOUBLE END AS tectonic_activity_score FROM feat), """ + ", ".join(
    f"""s{k} AS (SELECT {x}, row_number() OVER (ORDER BY count(*) DESC, {x})-1 AS i{k}, count(*)::DOUBLE/(sum(count(*)) OVER ()) AS share, sum(count(*)) OVER () AS n FROM feat GROUP BY {x}),
 e{k} AS (SELECT {x}, i{k}, -share/sqrt(share*(1-share)*n/(n-1)) AS zero{k}, 1/sqrt(share*(1-share)*n/(n-1)) AS step{k} FROM s{k})""" for k, x in enumerate(VARYING))
JOINED = "whole " + " ".join(f"JOIN e{k} USING ({x})" for k, x in enumerate(VARYING))
SIZES = [f"(SELECT count(*) FROM e{k})" for k in range(len(VARYING))]


def entries(t: Tables):
    """(id, raw, scaled): both feature vectors as arrays."""
    from pyspark.ml.functions import vector_to_array

    _, rows = features(t)
    return rows.select("id", *[vector_to_array(f"features_{x}").alias(x) for x in ("raw", "scaled")])


def numbers(vector: str):
    return [F.get(vector, i).alias(name) for i, name in enumerate(prepare.NUMERIC)]


@query("l2_encoded_categories", f"WITH {FEAT}, " + ", ".join(
    f"i{k} AS (SELECT {x}, (row_number() OVER (ORDER BY count(*) DESC, {x})-1)::DOUBLE AS {x}_index FROM feat GROUP BY {x})" for k, x in enumerate(VARYING))
    + f" SELECT id, {', '.join(x + '_index' for x in VARYING)} FROM feat " + " ".join(f"JOIN i{k} USING ({x})" for k, x in enumerate(VARYING)))
def _(t: Tables):
    _, rows = features(t)
    return rows.select("id", *[x for x in rows.columns if x.endswith("_index")])


@query("l3_feature_vectors", f"WITH {WHOLE} SELECT id, {', '.join(r(f'{x}::DOUBLE') + f' AS {x}' for x in prepare.NUMERIC)}, "
    + f"({WIDTH} + {' + '.join(SIZES)})::INTEGER AS entries, concat_ws(',', "
    + ", ".join(f"({' + '.join([str(WIDTH), *SIZES[:k], f'i{k}'])})::INTEGER" for k in range(len(VARYING))) + f") AS ones FROM {JOINED}")
def _(t: Tables):
    """Every entry: the numeric ones by value, the encoded ones by the places of the ones among zeros."""
    place = F.transform("raw", lambda x, i: F.when((i >= WIDTH) & (x != 0), F.when(x == 1, i).otherwise(-1)))
    rows = entries(t).select("id", *numbers("raw"), F.size("raw").alias("entries"), F.array_join(F.array_compact(place), ",").alias("ones"))
    return rounded(rows, *prepare.NUMERIC)


@query("l4_scaled_features", f"WITH {WHOLE} SELECT id, " + ", ".join(
    f"{r(f'({x}-avg({x}) OVER ())/stddev_samp({x}) OVER ()')} AS {x}" for x in prepare.NUMERIC)
    + f", {r(' + '.join(f'zero{k}+step{k}' for k in range(len(VARYING))))} AS ones, "
    + r(" + ".join(f"(SELECT sum(zero{k}) FROM e{k}) + step{k}" for k in range(len(VARYING)))) + f" AS encoded FROM {JOINED}")
def _(t: Tables):
    """Every numeric entry; of the encoded ones the sum of those that stand for a row's categories, and of all."""
    def total(values):
        return F.aggregate(F.slice(values, F.lit(WIDTH + 1), F.size("raw")), F.lit(0.0), lambda a, x: a + x)

    ones = F.zip_with("raw", "scaled", lambda x, y: F.when(x == 1, y).otherwise(0.0))
    rows = entries(t).select("id", *numbers("scaled"), total(ones).alias("ones"), total(c("scaled")).alias("encoded"))
    return rounded(rows, *prepare.NUMERIC, "ones", "encoded")


@query("l5_principal_components", "SELECT i::INTEGER AS component, true AS uncorrelated, true AS descending FROM range(10) g(i)")
def _(t: Tables):
    """What makes them principal: no two components correlate, and their variances fall."""
    from pyspark.ml.functions import vector_to_array

    _, rows = features(t)
    v = rows.select(vector_to_array("features_pca").alias("v"))
    spread = v.agg(*[F.var_pop(c("v")[i]).alias(f"v{i}") for i in range(10)],
                   *[F.covar_pop(c("v")[i], c("v")[j]).alias(f"c{i}_{j}") for i in range(10) for j in range(i)])
    cells = []
    for i in range(10):
        small = F.lit(True)
        for j in range(10):
            if i != j:
                small = small & (F.abs(c(f"c{max(i, j)}_{min(i, j)}")) < 1e-6)
        cells.append(F.struct(F.lit(i).alias("component"), small.alias("uncorrelated"),
                              (F.lit(True) if i == 0 else c(f"v{i}") <= c(f"v{i - 1}") + 1e-9).alias("descending")))
    return spread.select(F.explode(F.array(*cells)).alias("x")).select("x.*")


@query("l7_label_encoding", f"WITH RECURSIVE {CLUSTERS}, n AS (SELECT risk_zone, (row_number() OVER (ORDER BY risk_zone)-1)::DOUBLE AS label FROM (SELECT DISTINCT risk_zone FROM clus)) SELECT id, risk_zone, label FROM clus JOIN n USING (risk_zone)")
def _(t: Tables):
    return models.encode_labels(t.clusters.select("id", "risk_zone"))


@query("l8_stratified_split", f"WITH {PROC} SELECT region, count(*) AS \"rows\", round(count(*)*0.2::DOUBLE)::BIGINT AS test_rows FROM proc GROUP BY 1")
def _(t: Tables):
    marked = split.stratified_split(t.processed.select("id", "region"), "region", 0.2)
    return marked.groupBy("region").agg(F.count(F.lit(1)).alias("rows"), F.count_if("is_test").alias("test_rows"))


# Rows left for training by the exact split, and the share of the largest class.
TRAINED = """tr AS (SELECT sum(n - round(n*0.2::DOUBLE)::BIGINT)::BIGINT AS training_samples FROM (SELECT count(*) AS n FROM clus GROUP BY risk_zone))"""


def fitted(t: Tables, name: str):
    """What holds for any sound fit: the samples it saw, metrics within bounds, better than chance among four zones."""
    row = comparison(t)[1].filter(c("model_name") == name)
    within = F.lit(True)
    for x in ("accuracy", "precision", "recall", "f1_score"):
        within = within & c(x).between(0.0, 1.0)
    return row.select("model_name", c("training_samples").cast("bigint").alias("training_samples"), within.alias("in_bounds"), (c("accuracy") > 0.25).alias("learned"))


@query("l9_random_forest", f"WITH RECURSIVE {CLUSTERS}, {TRAINED} SELECT 'RandomForest' AS model_name, training_samples, true AS in_bounds, true AS learned FROM tr")
def _(t: Tables):
    return fitted(t, "RandomForest")


@query("l10_logistic_regression", f"WITH RECURSIVE {CLUSTERS}, {TRAINED} SELECT 'LogisticRegression' AS model_name, training_samples, true AS in_bounds, true AS learned FROM tr")
def _(t: Tables):
    return fitted(t, "LogisticRegression")


@query("l11_grid_search", "SELECT n::INTEGER AS \"numTrees\", depth::INTEGER AS max_depth, leaf::INTEGER AS min_leaf, subset AS features_per_node, true AS in_bounds, true AS ordered, 1::BIGINT AS best_settings FROM (VALUES (100),(200),(300)) t(n), (VALUES (10),(20),(30)) d(depth), (VALUES (1),(2),(4)) v(leaf), (VALUES ('sqrt'),('log2'),('all')) s(subset)")
def _(t: Tables):
    """All 81 settings of the default grid over its five folds."""
    found = models.search(with_extended_features(t.training.drop("is_test")))
    top = found.agg(F.max("f1_weighted").alias("top"), F.count_if("best").alias("best_settings"))
    return found.withColumns({n: F.lit(v) for n, v in top.first().asDict().items()}).select(
        "numTrees", c("maxDepth").alias("max_depth"), c("minInstancesPerNode").alias("min_leaf"),
        c("featureSubsetStrategy").alias("features_per_node"),
        (c("f1_lowest").between(0.0, 1.0) & c("f1_highest").between(0.0, 1.0)).alias("in_bounds"),
        ((c("f1_lowest") <= c("f1_weighted") + 1e-12) & (c("f1_weighted") <= c("f1_highest") + 1e-12)
         & (~c("best") | (c("f1_weighted") == c("top")))).alias("ordered"),
        "best_settings",
    )


@query("l11_stratified_folds", f"WITH {PROC}, n AS (SELECT region, count(*) AS n FROM proc GROUP BY 1) SELECT region, f::INTEGER AS fold, (n//5 + CASE WHEN f < n%5 THEN 1 ELSE 0 END) AS \"rows\" FROM n, range(5) g(f)")
def _(t: Tables):
    return split.stratified_folds(t.processed.select("id", "region"), "region", 5).groupBy("region", "fold").agg(F.count(F.lit(1)).alias("rows"))


@query("l12_weighted_metrics", f"WITH RECURSIVE {CLUSTERS}, {GUESS} SELECT {r('sum(hit)/sum(support)')} AS accuracy, {r('sum(p*support)/sum(support)')} AS precision, {r('sum(rc*support)/sum(support)')} AS recall, {r('sum(f*support)/sum(support)')} AS f1_score FROM rep2")
def _(t: Tables):
    return rounded(metrics.weighted_metrics(guesses(t)), "accuracy", "precision", "recall", "f1_score")


CLASSES = ["Extreme", "High", "Low", "Moderate"]


@query("l13_confusion_matrix", f"WITH RECURSIVE {CLUSTERS}, {GUESS} SELECT label, " + ", ".join(f"count(*) FILTER (WHERE prediction='{k}') AS \"{k}\"" for k in CLASSES) + " FROM g GROUP BY 1")
def _(t: Tables):
    return metrics.confusion_matrix(guesses(t), CLASSES)


@query("l13_class_report", f"WITH RECURSIVE {CLUSTERS}, {GUESS} SELECT class, {r('p')} AS precision, {r('rc')} AS recall, {r('f')} AS f1_score, support FROM rep2")
def _(t: Tables):
    return rounded(metrics.class_report(guesses(t)).drop("hit"), "precision", "recall", "f1_score")


def importances(t: Tables):
    return models.feature_importances(t.spark, comparison(t)[0]["RandomForest"])


@query("l14_feature_importances", "SELECT 9::BIGINT AS features, 1.0::DOUBLE AS total, true AS positive")
def _(t: Tables):
    found = importances(t).agg(F.countDistinct("feature").alias("features"), F.sum("importance").alias("total"), (F.min("importance") >= 0).alias("positive"))
    return rounded(found, "total")


@query("k7_top_features", "SELECT i::INTEGER AS place, i::BIGINT AS larger FROM range(5) g(i)")
def _(t: Tables):
    """Place i has i features above it."""
    every = importances(t)
    top = models.top_features(every).collect()
    rows = [(i, sum((r["importance"], x["feature"]) > (x["importance"], r["feature"]) for r in every.collect())) for i, x in enumerate(top)]
    return t.spark.createDataFrame(rows, "place int, larger bigint")


@query("l15_best_model", f"WITH RECURSIVE {CLUSTERS}, {TRAINED} SELECT training_samples, true AS best, true AS named FROM tr")
def _(t: Tables):
    best, every = models.best_model(comparison(t)[1]), comparison(t)[1]
    highest = every.agg(F.max("f1_score").alias("m")).scalar()
    return best.select(c("training_samples").cast("bigint").alias("training_samples"), (c("f1_score") == highest).alias("best"),
                       c("model_name").isin("RandomForest", "LogisticRegression").alias("named"))


@query("l16_scored_clusters", f"WITH RECURSIVE {CLUSTERS} SELECT id, cluster_id, true AS known_zone, true AS sure FROM clus")
def _(t: Tables):
    scored = models.score(t.clusters, t.processed, comparison(t)[0]["RandomForest"])
    zones = [r[0] for r in t.clusters.select("risk_zone").distinct().collect()]
    return scored.select("id", "cluster_id", c("risk_zone").isin(zones).alias("known_zone"), (c("probability") > 1 / len(zones) - 1e-9).alias("sure"))


@query("l16_batch_independent", f"WITH RECURSIVE {CLUSTERS} SELECT id, true AS same FROM clus WHERE risk_zone = 'Low'")
def _(t: Tables):
    """An event scores the same in a small batch as among all events."""
    model, few = comparison(t)[0]["RandomForest"], t.clusters.filter("risk_zone = 'Low'")
    alone = models.score(few, t.processed, model).select("id", c("risk_zone").alias("zone"), c("probability").alias("p"))
    among = models.score(t.clusters, t.processed, model).select("id", "risk_zone", "probability")
    return alone.join(among, "id").select("id", (c("zone").eqNullSafe(c("risk_zone")) & (F.abs(c("p") - c("probability")) < 1e-9)).alias("same"))


@query("l16_scored_without_model", f"WITH RECURSIVE {CLUSTERS} SELECT id, risk_zone FROM clus")
def _(t: Tables):
    return models.score(t.clusters.drop("risk_zone"), t.processed, None).select("id", "risk_zone")


@query("l17_saved_model", f"WITH RECURSIVE {CLUSTERS} SELECT id, true AS same FROM clus")
def _(t: Tables):
    """The model read back scores every event as the fitted one does."""
    path = sinks.scratch_path(t.catalog, "model")
    model = comparison(t)[0]["LogisticRegression"]
    models.save(model, path)
    first = models.score(t.clusters, t.processed, model).select("id", c("risk_zone").alias("zone"), c("probability").alias("p"))
    again = models.score(t.clusters, t.processed, models.load(path)).select("id", "risk_zone", "probability")
    same = c("zone").eqNullSafe(c("risk_zone")) & (F.abs(c("p") - c("probability")) < 1e-9)
    return first.join(again, "id").select("id", same.alias("same"))


@query("g3_k_means_silhouettes", "SELECT i::INTEGER AS k, true AS in_bounds FROM range(2, 11) g(i)")
def _(t: Tables):
    found = kept(t, "k_means", lambda: models.choose_k_means(features(t)[1]))[1]
    return found.select("k", c("silhouette").between(-1.0, 1.0).alias("in_bounds"))


@query("a4_k_means_profile", f"WITH {FEAT} SELECT count(*) AS events, {r('avg(magnitude)')} AS avg_magnitude, {r('avg(depth)')} AS avg_depth FROM feat")
def _(t: Tables):
    """The profiles, weighted by their sizes, add up to the whole catalog."""
    rows = features(t)[1]
    model, _ = kept(t, "k_means", lambda: models.choose_k_means(rows))
    whole = models.k_means_profile(model.transform(rows)).agg(
        F.sum("cluster_size").alias("events"),
        *[(F.sum(c(x) * c("cluster_size")) / F.sum("cluster_size")).alias(x) for x in ("avg_magnitude", "avg_depth")])
    return rounded(whole, "avg_magnitude", "avg_depth")
