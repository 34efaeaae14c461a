"""Each registered query against its SQL on the driver tables."""

import os

import pytest
from support import difference, duck

import __spark_entry__ as driver
from starmart.checks import oracle, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = queries.queries()
ORACLES = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(driver.queries())


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert [r["month"] for r in rows] == list(range(1, 13))
