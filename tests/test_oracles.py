"""Every registered query of the engine against its SQL on DuckDB."""

import os

import pytest

from tests.harness import connect, difference
from veriframe.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    table = QUERIES[name](spark, SF).toArrow()
    if name in SQL:
        assert difference(table, con.execute(SQL[name]).to_arrow_table()) == ""
    else:
        assert table.num_rows > 0


def test_sql_has_queries():
    assert set(SQL) <= set(QUERIES)
