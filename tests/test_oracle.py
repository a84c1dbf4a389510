"""Every query with an SQL counterpart gives the same rows."""

import pytest

import __spark_entry__
from tests.oracle import connect, differences
from workload import ORACLES, QUERIES



@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf_dir, connection, name):
    found = QUERIES[name](spark, sf_dir).toPandas()
    expected = connection.execute(ORACLES[name]).df()
    assert len(found) > 0
    assert differences(found, expected) == []


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"ivf_recall"}


def test_entry_gives_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0
