"""Declared schemas. Nothing is inferred from data."""

from pyspark.sql import types as T

_S, _D, _I, _L, _TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.TimestampType()


def _struct(*pairs) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


FEATURE = _struct(
    ("id", _S),
    ("properties", _struct(
        ("mag", _D), ("place", _S), ("time", _L), ("updated", _L), ("felt", _I), ("cdi", _D), ("mmi", _D),
        ("alert", _S), ("status", _S), ("tsunami", _I), ("sig", _I), ("net", _S), ("code", _S), ("ids", _S),
        ("sources", _S), ("types", _S), ("nst", _I), ("dmin", _D), ("rms", _D), ("gap", _D), ("magType", _S),
        ("type", _S), ("url", _S), ("detail", _S), ("locationSource", _S), ("magSource", _S),
    )),
    ("geometry", _struct(("coordinates", T.ArrayType(_D)))),
)

FEATURE_COLLECTION = T.StructType([T.StructField("features", T.ArrayType(FEATURE))])

# The canonical event catalog every operator works on.
CATALOG = _struct(
    ("id", _S), ("time", _TS), ("updated", _TS), ("latitude", _D), ("longitude", _D), ("depth", _D),
    ("magnitude", _D), ("magnitude_type", _S), ("place", _S), ("felt", _I), ("cdi", _D), ("mmi", _D),
    ("alert", _S), ("status", _S), ("tsunami", _I), ("sig", _I), ("net", _S), ("nst", _I), ("dmin", _D),
    ("rms", _D), ("gap", _D), ("type", _S),
)

# Flat landing format: 14 columns, times in epoch milliseconds.
RAW_CATALOG = _struct(
    ("id", _S), ("time", _L), ("latitude", _D), ("longitude", _D), ("depth", _D), ("magnitude", _D),
    ("magnitude_type", _S), ("place", _S), ("significance", _I), ("alert", _S), ("tsunami", _I), ("year", _I),
    ("extraction_timestamp", _L), ("data_source", _S),
)

# Flat landing format of the evaluation job: time is text.
EVALUATION_CATALOG = _struct(
    ("id", _S), ("time", _S), ("latitude", _D), ("longitude", _D), ("depth", _D), ("magnitude", _D), ("place", _S),
)


def _dec(p, s):
    return T.DecimalType(p, s)


PROCESSED_TABLE = _struct(
    ("id", _S), ("magnitude", _dec(4, 2)), ("latitude", _dec(10, 7)), ("longitude", _dec(10, 7)),
    ("depth", _dec(8, 3)), ("time", _TS), ("place", _S), ("spatial_density", _dec(10, 6)),
    ("hazard_score", _dec(6, 3)), ("region", _S), ("magnitude_category", _S), ("depth_category", _S),
)

CLUSTER_TABLE = _struct(
    ("id", _S), ("cluster_id", _I), ("cluster_label", _S), ("risk_zone", _S), ("centroid_lat", _dec(10, 7)),
    ("centroid_lon", _dec(10, 7)), ("cluster_size", _I), ("avg_magnitude", _dec(4, 2)), ("max_magnitude", _dec(4, 2)),
)

HAZARD_ZONE_TABLE = _struct(
    ("zone_id", _I), ("risk_level", _S), ("avg_magnitude", _dec(4, 2)), ("event_count", _I),
    ("boundary_coordinates", _S), ("center_lat", _dec(10, 7)), ("center_lon", _dec(10, 7)), ("area_km2", _dec(10, 3)),
)

CLASSIFICATION_TABLE = _struct(
    ("earthquake_id", _S), ("classified_risk_zone", _S), ("classification_confidence", _dec(6, 4)),
    ("model_version", _S),
)

MODEL_TABLE = _struct(
    ("model_name", _S), ("model_type", _S), ("accuracy", _dec(6, 4)), ("precision_score", _dec(6, 4)),
    ("recall_score", _dec(6, 4)), ("f1_score", _dec(6, 4)), ("training_samples", _I),
)
