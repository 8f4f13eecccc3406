import pytest

import __spark_entry__ as entry
from decisionlake.llm import queries as q
from tests.compare import compare, connection


@pytest.fixture(scope="module")
def con(small):
    return connection(small)


@pytest.mark.parametrize("name", list(q.QUERIES))
def test_query(spark, con, small, name):
    said = compare(spark, con, small, name, entry.queries()[name], q.ORACLES.get(name))
    assert said.startswith(("ok", "rows-only")), said
