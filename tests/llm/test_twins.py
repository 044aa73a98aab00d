"""Queries with a SQL twin against DuckDB, whole rows."""

import pytest

from rowharbor.llm import queries as q
from tests.compare import compare, connect


@pytest.mark.parametrize("name", q.ORACLES)
def test_query_equals_its_sql(spark, sf_dir, name):
    got, want = compare(spark, connect(sf_dir), q.QUERIES[name], q.ORACLES[name], sf_dir)
    assert got == want
