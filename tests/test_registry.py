"""Every registered query against its SQL, on whole tables."""

import oracle
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_every_query_has_sql():
    without = {name for name in QUERIES if name.startswith("op") and name[2].isdigit() or name == "pipeline"}
    assert set(QUERIES) - without == set(SQL) - without


@pytest.mark.parametrize("name", SQL)
def test_query_matches_sql(spark, con, name):
    assert oracle.compare(spark, con, FOLDER, QUERIES[name], SQL[name]) is None


def test_entry(spark):
    assert 0 < entry.entry(spark).count() <= 20
