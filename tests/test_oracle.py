"""Every registered query with SQL gives DuckDB's rows."""

import os

import pytest

from millrace.plans import oracle, registry

from .compare import connect, differ

SF = os.environ.get("MILLRACE_SF", "/root/testdata/sf0.001")
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = connect(SF)
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    assert differ(spark, con, SF, registry.queries()[name], SQL[name]) is None


def test_every_query_has_sql():
    assert set(registry.queries()) - set(SQL) == {"db_size_stats"}
