"""Every registered query against its oracle SQL on the smallest sample tables."""
from __future__ import annotations

from pathlib import Path

import pytest
from oracle import connect, oracle_side, spark_side

from pitf.catalog import registered

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="sample tables not present")
QUERIES, ORACLE = registered.queries(), registered.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    columns, rows = spark_side(QUERIES[name](spark, SF))
    assert rows
    if name in ORACLE:
        assert (columns, rows) == oracle_side(con, ORACLE[name])


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 148
