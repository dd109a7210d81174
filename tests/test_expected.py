
from __future__ import annotations

import os

import pytest
from comparison import database, differences, types
from expected_sql import EXPECTED

import __spark_entry__ as driver

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES = driver.queries()


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_every_query_has_expected_sql():
    own = {name for name in QUERIES if name not in driver.LLM_QUERIES}
    assert own == set(EXPECTED)
    assert EXPECTED.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_query(spark, con, name):
    result = QUERIES[name](spark, FOLDER)
    assert types(result, con, EXPECTED[name]) == []
    assert differences(result, con, EXPECTED[name]) == []


def test_flagship_query(spark):
    assert driver.entry(spark).count() > 0
