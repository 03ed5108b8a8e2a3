"""Every registered query against its DuckDB oracle (sf0.001 here; the driver uses sf0.01)."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from wellmart.plans import driver_queries
from tests.oracle_check import compare, duck

SF = os.environ.get("WELLMART_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(driver_queries.ORACLE) == set(driver_queries.QUERIES) <= set(queries())
    assert set(driver_queries.ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(driver_queries.QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF, name, queries()[name], oracle_sql()[name], con)
    assert r["ok"], r.get("why")


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert len(df.columns) == len(set(c.lower() for c in df.columns))
    assert df.schema == entry(spark).schema
