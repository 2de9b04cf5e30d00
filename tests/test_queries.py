import pytest
from oracle import compare, connect

import __spark_entry__ as driver
from martkit.catalogue import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_its_sql(spark, con, name):
    rows = compare(driver.queries()[name](spark, SF_DIR), con, driver.oracle_sql()[name])
    assert rows > 0


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= driver.queries().keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()


def test_entry(spark):
    assert driver.entry(spark).count() > 900
