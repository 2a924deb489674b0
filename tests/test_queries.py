"""Every named query against its oracle SQL, on the small scale."""

import duckdb
import pytest

import __spark_entry__ as contract
import check

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, con, name):
    state, note, _ = check.compare(spark, con, name, DATA)
    assert state in ("OK", "ROWS"), note


def test_oracles_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 1
