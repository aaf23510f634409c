"""Every registered query against its SQL on DuckDB, over whole tables."""

import os

import pytest

import __spark_entry__ as driver
import oracle_check
from relaylog.plans import oracle
from relaylog.plans import queries as registered

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Those of the optional subpackage have their own tests.
QUERIES = {name: driver.queries()[name] for name in registered.all_queries()}
SQL = {name: driver.oracle_sql()[name] for name in oracle.all_sql()}


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, name):
    assert oracle_check.compare(spark, con, name, QUERIES[name], SQL[name], SF_DIR) == ""


def test_entry(spark):
    assert set(driver.entry(spark).columns) == {"destination_id", "partition", "outcome", "records"}
