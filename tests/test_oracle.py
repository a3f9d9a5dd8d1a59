"""Every query against its SQL on the smallest driver tables."""

import pytest
from compare import difference, duckdb_over

import __spark_entry__ as entry
from testkit import oracle, registry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.QUERIES, oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duckdb_over(SF)


def test_only_model_queries_have_no_sql():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {
        "train_metrics", "feature_importance", "score_customers", "end_to_end_segments",
        "end_to_end_distribution", "boost_rounds",
    }


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF), duck, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_model_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert len(entry.entry(spark).columns) == 47
