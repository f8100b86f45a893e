"""Every registered query against its oracle SQL on the smallest data set; the others must return rows."""

import pytest

import __spark_entry__ as entry
from check_oracle import connect, differences

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.base.QUERIES, entry.base.ORACLES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_names():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, con, name):
    found = differences(con, spark, SF, QUERIES[name], ORACLES[name])
    assert found == "" or found.startswith("(equal)"), found


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_returns_rows(spark, name):
    assert not QUERIES[name](spark, SF).isEmpty()


def test_entry(spark):
    out = entry.entry(spark)
    assert out.count() == 450
    assert "fraud_rate" in out.columns
