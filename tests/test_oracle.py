"""Every registered query against the SQL it must agree with, run by DuckDB on the same tables."""

import datetime
import math
import os

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from squadweave.plans.queries import ORACLE, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return sorted(tuple(repr(plain(row[at])) for at in order) for row in rows)


def kinds(rows, columns):
    """Python type of every column that is not null throughout."""
    found = {}
    for at, name in enumerate(columns):
        found[name] = {type(row[at]).__name__ for row in rows if row[at] is not None}
    return found


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", [name for name in oracle_sql() if name in ORACLE])
def test_agrees_with_sql(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    got = [tuple(row) for row in df.collect()]
    found = duck.execute(oracle_sql()[name])
    columns = [column[0] for column in found.description]
    expected = found.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert len(expected) > 0
    assert len(got) == len(expected)
    assert kinds(got, df.columns) == kinds(expected, columns)
    assert sorted_rows(df.columns, got) == sorted_rows(columns, expected)
