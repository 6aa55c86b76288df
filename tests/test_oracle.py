"""Every registered query against its SQL, and the flagship query."""

import pytest

import __spark_entry__ as entry
from oracle import connect, diff

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in SQL:
        assert diff(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert rows and {r.zoom for r in rows} == {0, 1, 2, 3}
