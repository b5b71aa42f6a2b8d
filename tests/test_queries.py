"""Every query against its SQL twin, on the smallest test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from workload.oracle import ORACLE
from workload.queries import all_queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
QUERIES, SQL = all_queries(), ORACLE

PAIRING = ["CartesianProduct", "BroadcastNestedLoopJoin"]
PYTHON = ["BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def ordered(columns, rows):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in places) for r in rows)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not [bad for bad in PAIRING + PYTHON if bad in plan]
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    expected = ordered(columns, cursor.fetchall())
    assert expected
    assert ordered(frame.columns, [tuple(r) for r in frame.collect()]) == expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns[0] == "job_id" and frame.count() > 0
