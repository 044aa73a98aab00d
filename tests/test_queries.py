"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as entry_points
from compare import compare, connect

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    if name not in ORACLES:
        assert QUERIES[name](spark, sf_dir).count() > 0
        return
    got, want = compare(spark, con, QUERIES[name], ORACLES[name], sf_dir)
    assert got == want
    assert got[1], "an empty result shows nothing"


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[0] == "o_orderkey" and df.count() == 1500


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
