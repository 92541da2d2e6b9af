import pytest

from tessella.llm.oracles import ORACLES
from tessella.llm.queries import QUERIES
from tests.oracle import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf, name):
    compare(spark, connect(sf), QUERIES[name], ORACLES[name], sf)
