"""Every registered query: against its check SQL where it has one, and without all-pairs joins."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    assert compare(spark, con, entry.queries()[name], ORACLE.get(name), SF) == ""


def test_every_check_belongs_to_a_query():
    assert set(ORACLE) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "household_id"
    assert "PCT_CAT_DIV_%PROMO%_SPEND" in df.columns
    assert df.count() > 0
