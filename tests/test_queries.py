"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry_point
from compare import connect, differences
from contactflow.plans import oracles
from contactflow.plans.queries import REGISTRY

QUERIES = REGISTRY
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_entry(spark):
    rows = entry_point.entry(spark)
    assert rows.columns == ["region", "comuna", "total"]
    assert rows.count() > 0
