"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_points
from oracle import compare, connect
from stepwise.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem = compare(spark, con, name, QUERIES[name], ORACLES[name], FOLDER)
    assert problem in (None, "both empty"), problem


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.count() > 0 and "status" in frame.columns
