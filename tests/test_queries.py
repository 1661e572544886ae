"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from compare import database, differences

import __spark_entry__ as entry_points
from kilnwatch.plans.catalog import QUERIES
from kilnwatch.plans.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def connection():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    rows = QUERIES[name](spark, SF_DIR)
    ours, theirs, extra, missing = differences(rows, ORACLES[name], connection)
    assert (extra, missing) == ([], [])
    assert ours == theirs > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
