"""Every registered query against its DuckDB oracle on the driver's tables."""

from __future__ import annotations

import os

import pytest
from oracle_compare import differences, duck

from __spark_entry__ import entry, oracle_sql, own_queries, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    connection = duck(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert set(own_queries()) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(own_queries()))
def test_query_matches_oracle(spark, con, name):
    assert differences(own_queries()[name](spark, SF_DIR), con, oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
