"""Every catalog query against its SQL on the smallest driver tables."""

import __spark_entry__ as entry
import check
import pytest

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return check.database(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert len(got) > 0
    if name in SQL:
        assert check.differences(got, con.execute(SQL[name]).df()) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(entry.queries())
