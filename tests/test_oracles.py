"""Registered queries against SQL on the smallest tables."""

import datetime
import glob
import os

import duckdb
import pytest

from delayhouse.plans import catalog, oracles

SF = "/root/testdata/sf0.001"
@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


def plain(value):
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(oracles.statements()))
def test_query_equals_sql(spark, duck, name):
    got = catalog.queries()[name](spark, SF)
    result = duck.execute(oracles.statements()[name])
    assert table(got.columns, got.collect()) == table([c[0] for c in result.description], result.fetchall())
