"""Every checked query against its SQL on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as entry
from auditloom.plans import checks
from auditloom.plans.standins import TABLES
from tools.compare import normal, same

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    made = duckdb.connect()
    for name in TABLES:
        made.execute(f"create view {name} as select * from '{DATA}/{name}.parquet'")
    return made


def test_every_base_query_has_sql():
    assert set(checks.QUERIES) == set(checks.ORACLES) and set(checks.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(checks.QUERIES))
def test_query(spark, con, name):
    mine = checks.QUERIES[name](spark, DATA).toPandas()
    theirs = con.execute(checks.ORACLES[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert same(normal(mine), normal(theirs))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
