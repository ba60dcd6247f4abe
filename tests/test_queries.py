"""Every registered query against its SQL, on the smallest given tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

FOLDER = entry.SMOKE

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    result = entry.queries()[name](spark, FOLDER)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert result.count() > 0
    else:
        assert differences(result, con, sql) == []
