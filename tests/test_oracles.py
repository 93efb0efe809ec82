"""Every query with an oracle gives the same rows in Spark and in DuckDB."""

import pytest
from compare import differences, duck

from snapcredit.plans.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", list(ORACLES))
def test_oracle(spark, sf_dir, connection, name):
    assert differences(QUERIES[name](spark, sf_dir), connection, ORACLES[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns[:2] == ["Customer_ID", "snapshot_date"]
    assert set(contract.oracle_sql()) <= set(contract.queries())
