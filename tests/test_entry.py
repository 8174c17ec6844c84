"""Every query against the SQL that states its result, on the smallest tables; and the contract of the entry module."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def plain(value):
    return repr(round(value, 9)) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, sql, name):
    rows = entry.queries()[name](spark, FOLDER)
    columns = sorted(rows.columns)
    result = sql.execute(entry.oracle_sql()[name])
    place = [d[0] for d in result.description]
    assert sorted(place) == columns
    want = sorted(tuple(plain(r[place.index(c)]) for c in columns) for r in result.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in rows.collect()) == want


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
    typed = entry.queries()["p3_rows"](spark, FOLDER)
    assert typed.filter("order_id IS NULL").count() == 0 and typed.filter("business_version IS NOT NULL").count() > 0
