import pytest

from contract.check import canonical
from teamlines.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql_twin(spark, duck, name):
    ours = canonical(QUERIES[name](spark, SMALL).toPandas())
    theirs = canonical(duck.sql(ORACLES[name]).df())
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]
