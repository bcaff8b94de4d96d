"""Every registered query against its DuckDB oracle on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in entry.QUERIES}  # other packages test their own


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(entry.queries()[name](spark, SF), con, ORACLE[name])
    assert r["cols_match"] and r["exact"], r


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not present")
def test_entry_and_rows_only_queries(spark):
    assert entry.entry(spark).count() > 0
    for name in sorted(set(entry.QUERIES) - set(ORACLE)):
        assert entry.queries()[name](spark, SF).count() > 0, name
