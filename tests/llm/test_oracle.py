"""Queries with SQL give DuckDB's rows."""

import pytest
from millrace.llm import oracle, queries

from ..compare import connect, differ

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_same_rows(spark, name):
    con = connect(SF)
    assert differ(spark, con, SF, queries.queries()[name], oracle.oracle_sql()[name]) is None
    con.close()
