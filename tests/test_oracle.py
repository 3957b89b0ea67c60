"""Every registered query that has a SQL statement gives the same rows as DuckDB."""

import oracle
import pytest

from larkspur.plans import all_queries, all_sql

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def con(small_dir):
    return oracle.connect(small_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, small_dir, name):
    df = QUERIES[name](spark, small_dir)
    assert oracle.type_differences(df, con, SQL[name]) == ""
    assert oracle.differences(df, con, SQL[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, small_dir, name):
    assert QUERIES[name](spark, small_dir).count() > 0


def test_statements_belong_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["c_mktsegment", "n_orders", "total_price"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
