"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as driver
from compare import connect, differences
from workload import oracle, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    text, _ = differences(spark, con, SF_DIR, name, QUERIES[name], SQL[name])
    assert text == ""


def test_entry(spark):
    assert driver.entry(spark).count() > 0
