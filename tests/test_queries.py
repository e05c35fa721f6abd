"""Every registered query against its SQL, over the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import bench
from tests.compare import difference, duck

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_benchmark_names_queries():
    assert set(bench.HEADLINE) <= set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    if name in SQL:
        assert difference(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "purchase_date"
