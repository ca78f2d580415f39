"""Every registered query against its expected result on the small tables."""

from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def connection(small):
    return connect(small)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, small, name):
    df = QUERIES[name](spark, small)
    if name in SQL:
        assert difference(df, connection, SQL[name]) is None
    else:
        assert df.count() > 0


def test_every_expected_result_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "risk_level" in df.columns
