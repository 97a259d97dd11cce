"""Every registered query with SQL agrees with DuckDB on the smallest tables (tests/check_oracle.py runs larger ones)."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect, type_classes

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = df.toPandas()
    if name not in SQL:
        assert len(got) > 0
        return
    assert compare(got, con.execute(SQL[name]).df()) == ""
    assert type_classes(df, con, SQL[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_all_sql_belongs_to_a_query():
    assert SQL.keys() <= QUERIES.keys()
