"""Registered queries beside their SQL on the smallest tables; python -m suite.check runs all of them on larger ones."""

from pathlib import Path

import pytest

from suite import load
from suite.check import compare, connect

FOLDER = "/root/testdata/sf0.001"
# Slow to set up, covered by tests/test_dbscan.py and by suite.check.
SLOW = {"g2_dbscan", "g2_dbscan_regional", "zone_ranking", "l2_encoded_categories", "l3_feature_vectors", "l4_scaled_features", "l11_grid_search"}

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")
QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n in ORACLES if n not in SLOW])
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), con, ORACLES[name], tolerance=2e-6) == ""


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
