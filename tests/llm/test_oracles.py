import pytest

from tests.harness import connect, difference
from veriframe.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, name):
    assert difference(QUERIES[name](spark, SF).toArrow(), connect(SF).execute(ORACLE_SQL[name]).to_arrow_table()) == ""
