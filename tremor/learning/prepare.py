"""Imputation, scaling and vector assembly."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    PCA, Bucketizer, Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor import constants as K
from tremor.operators.ranking import column_quantiles
from tremor.operators.stats import approximate_medians, population_moments
from tremor.workspace import constants, materialise

NUMERIC = [
    "magnitude", "depth", "latitude", "longitude", "felt", "cdi", "mmi", "sig", "nst", "dmin", "rms", "gap",
    "year", "month", "day", "hour", "ring_of_fire_distance", "energy_release_log", "risk_score",
    "population_impact_estimate", "tectonic_activity_score",
]
CATEGORICAL = [
    "alert_standardized", "magnitude_category", "depth_category_detailed", "geographic_zone", "season",
    "magnitude_type", "type",
]
NORMALISED = {
    "longitude": "lon_norm", "latitude": "lat_norm", "depth": "depth_norm", "magnitude": "mag_norm",
    "hazard_score": "hazard_norm", "intensity_score": "intensity_norm",
}


def exact_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the exact median of each column; NULL for an empty column."""
    long = column_quantiles(df, columns, [0.5])
    return long.agg(*[F.max(F.when(F.col("column") == c, F.col("quantile"))).alias(c) for c in columns])


def impute_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs become the exact median of the column, or 0 where a column is all NULL."""
    medians = constants(exact_medians(df, columns))
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({
        c: F.coalesce(F.col(c), F.coalesce(medians[c], F.lit(0.0)).cast(kinds[c])) for c in columns
    })


def imputer(columns: list[str]) -> Imputer:
    """Approximate medians as a pipeline stage."""
    return Imputer(strategy="median", inputCols=columns, outputCols=columns)


def z_scores(df: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    """(x - mean) / population deviation, NULL as 0 first; a constant column gives 0."""
    columns = columns or NORMALISED
    filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    moments = constants(population_moments(filled, list(columns)))
    added = {}
    for c, name in columns.items():
        centred = F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - moments[f"{c}_mean"]
        added[name] = F.coalesce(F.try_divide(centred, moments[f"{c}_std"]), F.lit(0.0))
    return df.withColumns(added)


def bucketize(df: DataFrame) -> DataFrame:
    """Left-closed magnitude and depth buckets."""
    stage = Bucketizer(
        splitsArray=[list(K.MAGNITUDE_SPLITS), list(K.DEPTH_SPLITS)],
        inputCols=["magnitude", "depth"], outputCols=["magnitude_bucket", "depth_bucket"], handleInvalid="keep",
    )
    return stage.transform(df)


def varying(df: DataFrame, columns: list[str]) -> list[str]:
    """The columns with at least two values. One job for all; the answer is a single row."""
    row = df.agg(*[(F.min(c) != F.max(c)).alias(c) for c in columns]).first()
    return [c for c in columns if row[c]]


def feature_stages(numeric: list[str], categorical: list[str], components: int = 10) -> list:
    """Index and encode the categories, assemble, standardise, project."""
    index = StringIndexer(
        inputCols=categorical, outputCols=[f"{c}_index" for c in categorical], handleInvalid="keep"
    )
    encode = OneHotEncoder(
        inputCols=[f"{c}_index" for c in categorical], outputCols=[f"{c}_encoded" for c in categorical]
    )
    assemble = VectorAssembler(
        inputCols=numeric + [f"{c}_encoded" for c in categorical], outputCol="features_raw"
    )
    scale = StandardScaler(inputCol="features_raw", outputCol="features_scaled", withMean=True, withStd=True)
    project = PCA(k=min(components, len(numeric)), inputCol="features_scaled", outputCol="features_pca")
    return ([index, encode] if categorical else []) + [assemble, scale, project]


def fit_features(df: DataFrame, components: int = 10) -> tuple[PipelineModel, DataFrame]:
    """(model, transformed rows) of the feature pipeline over the ETL features."""
    numeric = [c for c in NUMERIC if c in df.columns]
    written = materialise(df, "to-fill")
    medians = constants(approximate_medians(written, numeric))
    kinds = {f.name: f.dataType for f in df.schema.fields}
    filled = written.withColumns({c: F.coalesce(F.col(c), medians[c].cast(kinds[c])) for c in numeric})
    filled = materialise(filled.fillna("unknown", [c for c in CATEGORICAL if c in df.columns]), "filled")
    categorical = varying(filled, [c for c in CATEGORICAL if c in filled.columns])
    model = Pipeline(stages=feature_stages(numeric, categorical, components)).fit(filled)
    return model, bucketize(model.transform(filled))
