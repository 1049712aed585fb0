"""Every registered query against DuckDB on the given tables."""

import os

import pytest
from oracle import connect, differences

import __spark_entry__ as entry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    """Corpus operators that SQL cannot express have tests of their own."""
    with_sql = entry.oracle_sql().keys()
    assert with_sql <= entry.queries().keys()
    assert entry.queries().keys() - with_sql <= entry._corpus().keys()


@pytest.mark.parametrize("name", entry.oracle_sql())
def test_query_matches_oracle(spark, con, name):
    result = entry.queries()[name](spark, SF_DIR)
    assert differences(result, con, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
