import pytest

import __spark_entry__ as contract
from check_oracles import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_contract(spark):
    own = set(contract.QUERIES)
    assert own <= set(contract.queries()) and own == set(contract.ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(contract.QUERIES))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, SF, name) is None
