"""Every registered text query against its SQL, over a small table."""

from __future__ import annotations

import pytest

from tests.compare import difference, duck
from tillflow.llm import oracle, queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = queries.build(), oracle.build()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_all_operators():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == [*range(1, 14)] and set(SQL) < set(QUERIES)


@pytest.mark.parametrize("name", SQL)
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows(spark, name):
    # every row of its table has one in the result, but for those of leaks and of repeats, which have SQL
    table = "pages" if name == "op2_html_text" else "documents"
    assert QUERIES[name](spark, SF_DIR).count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
