"""Every registered query against its SQL on the smallest test tables."""

import glob
import os

import pytest

import __spark_entry__ as registered
from helpers import plan

duckdb = pytest.importorskip("duckdb")
NOT_WANTED = ("PythonUDF", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin")
QUERIES, SQL = registered.library_queries(), registered.library_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def comparable(records, columns, order):
    places = [columns.index(c) for c in order]
    return sorted((tuple(record[i] for i in places) for record in records), key=repr)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = con.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = comparable(result.fetchall(), columns, df.columns)
    assert comparable([tuple(r) for r in df.collect()], df.columns, df.columns) == expected
    assert expected, "an empty result checks nothing"
    for operator in NOT_WANTED:
        assert operator not in plan(df)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark, sf_dir):
    assert registered.entry(spark).limit(1).count() == 1
