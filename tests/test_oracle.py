"""Every registered query against its SQL on whole tables."""

import pytest

import __spark_entry__ as entry_module
from strataloom.plans import oracle
from strataloom.plans.workload import REGISTRY
from tests.compare import SF_DIR, duck, duck_rows, explain_difference, spark_rows

QUERIES, SQL = REGISTRY, oracle.SQL


@pytest.fixture(scope="module")
def con():
    return duck()


def test_each_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    names, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    want_names, want = duck_rows(con, SQL[name])
    assert names == want_names
    assert rows, "a query that returns nothing checks nothing"
    assert rows == want, explain_difference(rows, want)


def test_entry_is_the_flagship(spark):
    df = entry_module.entry(spark)
    assert df.count() == 150
    assert df.columns == ["user_id", "last_order", "n_orders", "total", "recency", "frequency", "monetary"]
