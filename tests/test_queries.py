"""Every registered query against its SQL, and the shape of every plan."""

import os

import pytest

from checks import registry
from checks.compare import connect, rows_of, rows_of_sql, types_of_sql
from checks.oracles import oracle_sql

SF_DIR = os.environ.get("WATTFRAME_SF_DIR", "/root/testdata/sf0.001")
QUERIES = registry.queries()
SQL = oracle_sql()
SPARK_TO_SQL = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = rows_of(df)
    if name not in SQL:
        assert got[1]
        return
    assert got == rows_of_sql(duck, SQL[name])
    assert {c: SPARK_TO_SQL[t] for c, t in df.dtypes} == types_of_sql(duck, SQL[name])


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"daily_users_estimate_streamed"}


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.endswith("_streamed") and "ingest" not in n and n != "loaded_tables"])
def test_plan_stays_distributed_and_in_the_engine(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in plan


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    core = lambda names: [n for n in names if not n.startswith("op") and n != "pipeline"]
    assert core(driver.queries()) == list(QUERIES)
    assert {n: driver.oracle_sql()[n] for n in core(driver.oracle_sql())} == SQL
