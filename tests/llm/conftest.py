"""Session-wide tables of awkward documents."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from fixtures import SCHEMA, as_rows, awkward_texts  # noqa: E402


@pytest.fixture(scope="session")
def texts():
    return awkward_texts()


@pytest.fixture(scope="session")
def docs(spark, texts):
    return spark.createDataFrame(as_rows(texts), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def docs_with_null(spark, texts):
    return spark.createDataFrame(as_rows([*texts, (None, "no id"), (None, None), (4, "another text of document four")]), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
