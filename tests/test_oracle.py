"""Every query with checking SQL equals it, row for row."""

import pytest
from conftest import SMALL
from oracle import compare, connect

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    message, _ = compare(spark, duck, entry.queries()[name], ORACLES[name], SMALL)
    assert not message


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 3
