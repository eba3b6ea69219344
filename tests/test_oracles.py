import pytest
from compare import assert_same
from conftest import DATA

from kinograph.plans import oracles, queries

QUERIES, SQL = queries.queries(), oracles.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    assert_same(spark, duck, QUERIES[name], SQL[name], DATA)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["movie_id", "cluster_id", "rank", "distance"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
