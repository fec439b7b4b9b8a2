import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import connect, difference

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_agrees_with_sql(spark, con, name):
    assert difference(queries()[name](spark, SF), oracle_sql()[name], con) is None


def test_entry(spark):
    assert entry(spark).columns == ["event_id", "user_id", "text", "date", "favorite_count", "n_status"]
    assert not entry(spark).isEmpty()
