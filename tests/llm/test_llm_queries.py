import pytest
from oracle import compare, connect

import __spark_entry__ as driver
from martkit.llm.oracles import ORACLES
from martkit.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_its_sql(spark, name):
    rows = compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name])
    assert rows > 0


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= driver.queries().keys()
    assert ORACLES.keys() <= driver.oracle_sql().keys()
