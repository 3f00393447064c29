"""Every query of the core that has SQL, over the whole smallest tables."""

import pytest

from millrace.plans import curation, reference
from tests.helpers import connect, rows_of, rows_of_sql

DIR = "/root/testdata/sf0.001"
QUERIES = {**reference.queries(), **curation.queries()}
SQL = {**reference.oracle_sql(), **curation.oracle_sql()}


@pytest.fixture(scope="module")
def con():
    return connect(DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    cols, got = rows_of(QUERIES[name](spark, DIR))
    want_cols, want = rows_of_sql(con, SQL[name])
    assert cols == want_cols
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DIR).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
