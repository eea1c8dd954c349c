"""Every registered query against its DuckDB oracle on the smallest data."""

import os

import pytest

from filing_release.plans.queries import QUERIES
from oracle_harness import compare, duck

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    fn, sql = QUERIES[name]
    if sql is None:
        assert fn(spark, SF).count() >= 0
        return
    r = compare(spark, con, name, fn, sql, SF)
    assert r["ok"], r


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns and df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
