"""Every registered query against its oracle SQL, on the smallest data."""

import oracle
import pytest

import __spark_entry__ as entry
from tidewater.plans import all_queries

SF = "/root/testdata/sf0.001"
OWN, SQL = all_queries()
QUERIES = {name: fn for name, fn in entry.queries().items() if name in OWN}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_oracle_has_a_query():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, SF), con, SQL[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "a_id", "b_id", "c_id", "start_ts", "end_ts"]
    assert df.count() == 10
