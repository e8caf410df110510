"""Every suite query against its SQL equivalent on the smallest tables."""

import pytest
from compare import compare, connect, library_queries
from conftest import SMALL

import __spark_entry__ as entry

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_an_oracle():
    assert library_queries() <= set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(library_queries()))
def test_query(spark, duck, name):
    assert compare(spark, duck, SMALL, QUERIES[name], ORACLE[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["product_name", "sales_count", "total_revenue"]
    revenue = [r.total_revenue for r in df.collect()]
    assert revenue and revenue == sorted(revenue, reverse=True)
