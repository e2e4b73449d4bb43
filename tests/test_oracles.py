"""Every query with SQL gives the rows, names and types that DuckDB gives."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import compare, connect

BASE = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(BASE), reason="test tables are not there")


@pytest.fixture(scope="module")
def db():
    return connect(BASE)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, db, name):
    df = queries()[name](spark, BASE)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, db, sql) == ""


def test_entry(spark):
    assert entry(spark).count() == 10
    assert set(oracle_sql()) <= set(queries())
