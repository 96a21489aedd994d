"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from chartlift.queries.registry import ORACLES, QUERIES
from tools.check_queries import SPARK_TO_DUCKDB, table_of

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.keys() <= entry.queries().keys()
    assert ORACLES.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    frame = QUERIES[name](spark, FOLDER)
    result = oracle.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    types = {d[0]: str(d[1]) for d in result.description}
    assert {f.name: SPARK_TO_DUCKDB[f.dataType.simpleString()] for f in frame.schema} == types
    assert table_of(frame.columns, [tuple(r) for r in frame.collect()]) == table_of(columns, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
