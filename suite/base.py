"""Registry of queries and the tables they read."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremor.operators.dbscan import dbscan
from tremor.plans import etl, evaluation, master
from tremor.session import apply_semantics
from tremor.sources.adapter import catalog_from_events
from tremor.workspace import materialise, new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one scale factor. Stored tables of the hazard chain are built once per session."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @cached_property
    def catalog(self) -> DataFrame:
        """The whole events table as a catalog, dealt by id and written once as the operators' input."""
        events = self.spark.read.parquet(f"{self.folder}/events.parquet")
        return materialise(catalog_from_events(events).repartition("id"), "catalog")

    @cached_property
    def enhanced(self) -> DataFrame:
        return etl.enhance(self.catalog)

    @cached_property
    def features(self) -> DataFrame:
        return etl.with_features(etl.clean(self.catalog))

    @cached_property
    def evaluated(self) -> DataFrame:
        return evaluation.derive(self.catalog)

    @cached_property
    def processed(self) -> DataFrame:
        return materialise(master.process(self.catalog).select(*master.PROCESSED_COLUMNS), "processed")

    @cached_property
    def labels(self) -> DataFrame:
        return materialise(dbscan(self.processed), "labels")

    @cached_property
    def stored(self) -> dict[str, DataFrame]:
        return master.stored_tables(self.processed, materialise(master.cluster(self.processed, labels=self.labels), "clusters"))

    @property
    def clusters(self) -> DataFrame:
        return self.stored["earthquake_clusters"]

    @property
    def classifications(self) -> DataFrame:
        return self.stored["earthquake_risk_classifications"]

    @property
    def zones(self) -> DataFrame:
        return self.stored["hazard_zones"]

    @cached_property
    def models(self) -> DataFrame:
        """The models of one training run, as the registry has stored them; none if there are too few classes."""
        from suite.learning import comparison
        from tremor.learning import models, registry

        path = new_path(self.spark, "registry")
        if models.trainable(self.training).first()["trainable"]:
            registry.register(*comparison(self), path)
        return registry.latest(registry.registered(self.spark, path))

    @cached_property
    def training(self) -> DataFrame:
        from tremor.learning.models import prepare_training

        return prepare_training(self.processed, self.clusters)


_tables: dict[tuple[str, str], Tables] = {}


def tables(spark: SparkSession, folder: str) -> Tables:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _tables:
        _tables[key] = Tables(apply_semantics(spark), folder)
    return _tables[key]


def query(name: str, sql: str | None = None):
    """Register ``f(tables) -> DataFrame`` under a name."""
    def register(f):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, folder: f(tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return f
    return register


def scalar(name: str, columns: dict[str, tuple[Callable[[], Column], str]], source: str = "catalog") -> None:
    """Register a projection of the catalog: column name -> (Spark expression, SQL expression)."""
    from suite.sql import EV

    listed = ", ".join(f"{sql} AS {c}" for c, (_, sql) in columns.items())

    @query(name, f"WITH {EV} SELECT id, {listed} FROM ev")
    def run(t: Tables) -> DataFrame:
        return getattr(t, source).select("id", *[make().alias(c) for c, (make, _) in columns.items()])


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: settled(F.col(c), digits) for c in columns})


def settled(x: Column, digits: int = 6) -> Column:
    """Rounded, with ties moved off the middle as in ``suite.sql.r``."""
    from suite.sql import TIE

    return F.round(x + F.lit(TIE * 10 ** -digits) if digits >= 6 else x, digits)


def stamp(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
