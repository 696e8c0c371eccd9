"""Each registered query against its plain SQL form, in another engine."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_point

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def other(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def ordered(rows, columns):
    places = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in places) for row in rows), key=repr)


def test_registry():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, sf_dir, other, name):
    frame = QUERIES[name](spark, sf_dir)
    cursor = other.execute(ORACLES[name])
    columns = [part[0] for part in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    assert ordered(frame.collect(), frame.columns) == ordered(cursor.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, sf_dir, name):
    assert not QUERIES[name](spark, sf_dir).isEmpty()


def test_entry(spark):
    assert entry_point.entry(spark).count() == 29
