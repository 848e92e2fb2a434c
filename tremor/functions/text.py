"""String, null and lookup expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.constants import ALERT_LEVELS


def strip_place(text: Column) -> Column:
    """Keep letters, digits, white space, comma and hyphen."""
    return F.regexp_replace(text, r"[^a-zA-Z0-9\s,-]", "")


def strip_text(text: Column) -> Column:
    """As :func:`strip_place`, keeping full stops too."""
    return F.regexp_replace(text, r"[^a-zA-Z0-9\s,.-]", "")


def standard_alert(alert: Column) -> Column:
    """Accepts all-lower or all-upper spelling only."""
    chain = F
    for level in ALERT_LEVELS:
        chain = chain.when(alert.isin(level, level.upper()), level)
    return chain.otherwise("unknown")


def lookup(key: Column, table: dict, default) -> Column:
    """Small constant mapping as a CASE expression."""
    chain = F
    for name, value in table.items():
        chain = chain.when(key == name, F.lit(value))
    return chain.otherwise(F.lit(default))


def alert_level(alert: Column) -> Column:
    return lookup(alert, ALERT_LEVELS, 0)


def cluster_label(cluster_id: Column) -> Column:
    return F.concat(F.lit("Cluster-"), cluster_id.cast("string"))


def replace_text(text: Column, old: str, new: str) -> Column:
    return F.when(text.contains(old), F.replace(text, F.lit(old), F.lit(new))).otherwise(text)


def round_numeric(value: Column, digits: int) -> Column:
    """Half away from zero."""
    return F.round(value, digits)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in any floating column becomes NULL."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})
