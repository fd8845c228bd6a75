"""Every registered query against its SQL, or for rows where it has none."""

import pytest

import __spark_entry__ as entry
from oracle import connect, differences

SF_DIR = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    if name in SQL:
        assert differences(got, con.execute(SQL[name]).df()) is None
    else:
        assert len(got) > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
