"""Named queries against their SQL on the smallest data."""

import pytest

import __spark_entry__ as entry
from check_queries import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    problem, _, _ = compare(spark, con, name, FOLDER)
    assert problem in (None, "no rows on either side"), problem


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
