"""The driver's contract: every query with SQL gives the same rows on the smallest data."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connection


@pytest.fixture(scope="module")
def con(small):
    return connection(small)


def _core():
    from decisionlake.queries import general, reference, stored

    return [(n, m.ORACLES.get(n)) for m in (reference, stored, general) for n in m.QUERIES]


@pytest.mark.parametrize(("name", "sql"), _core())
def test_query(spark, con, small, name, sql):
    said = compare(spark, con, small, name, entry.queries()[name], sql)
    assert said.startswith(("ok", "rows-only")), said


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
