"""Every registered query against its SQL twin, and the driver contract."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, normal

from fieldbook.probes import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
UNWANTED = ("BatchEvalPython", "ArrowEvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["id", "campaign", "responded", "response_id", "used", "spend_id"]
    assert df.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_values(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in UNWANTED:
        assert unwanted not in plan
    got = df.toPandas()
    want = duck.sql(contract.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)
