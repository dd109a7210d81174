"""Training-data queries against their SQL; those without any have a brute-force test by name."""

from __future__ import annotations

import os

import pytest
import test_llm
from comparison import database, differences, types

import __spark_entry__ as driver
from tributary.llm.queries import QUERIES, SQL

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
#: Queries that SQL cannot express, and the test that compares each with a plain version.
BY_TEST = {
    "op1_pii": "test_pii_base_spans",
    "op3_licenses": "test_licenses_like_a_plain_scan",
    "op4_best_fit_packing": "test_packing",
    "op5_toxicity": "test_toxicity_on_held_out_rows",
    "op8_secrets": "test_secrets_like_a_plain_scan",
    "op10_quality_rules": "test_quality_statistics_and_base_rule",
}


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_every_operator_has_sql_or_a_test():
    assert set(QUERIES) == set(SQL) | set(BY_TEST) and not set(SQL) & set(BY_TEST)
    assert all(hasattr(test_llm, name) for name in BY_TEST.values())
    assert QUERIES.items() <= driver.queries().items() and SQL.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    result = QUERIES[name](spark, FOLDER)
    assert types(result, con, SQL[name]) == []
    assert differences(result, con, SQL[name]) == []
