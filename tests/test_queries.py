"""Every registered query against its SQL twin; those without one must give rows."""

import pytest

from compare import difference, duck
from fleetrisk.checks import all_queries, all_sql

SF = "/root/testdata/sf0.01"
QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_names():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, name):
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)
