"""Every registered query against its SQL statement, over whole tables at the smallest scale."""

import os

import pytest
from oracle import DATA, compare, connect

from barloom import catalog

SF = os.path.join(DATA, os.environ.get("BARLOOM_TEST_SF", "sf0.001"))
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracles())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, SF, catalog.queries()[name], catalog.oracles()[name]) == []
