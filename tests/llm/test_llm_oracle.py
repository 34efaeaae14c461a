"""Queries of the llm subpackage against SQL, and against each other's row counts."""

import os

import pytest
from support import difference, duck

from starmart.llm import oracle, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = queries.queries()
ORACLES = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


def test_one_query_per_operator_and_the_pipeline():
    numbers = [int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline"]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in QUERIES
    assert set(ORACLES) <= set(QUERIES)
