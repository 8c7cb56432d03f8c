"""Every registered query against its SQL on whole tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as driver
from spendcast.entries import all_entries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
# The queries of the library's own operators; each has SQL.
ENTRIES = all_entries()
QUERIES = {name: driver.queries()[name] for name in ENTRIES}
SQL = {name: driver.oracle_sql()[name] for name in ENTRIES}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{file}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, FOLDER)
    columns = sorted(result.columns)
    expected = duck.execute(SQL[name])
    found_columns = [d[0] for d in expected.description]
    assert sorted(found_columns) == columns
    places = [found_columns.index(c) for c in columns]
    want = sorted((tuple(r[p] for p in places) for r in expected.fetchall()), key=repr)
    got = sorted((tuple(r[c] for c in columns) for r in result.collect()), key=repr)
    assert len(got) > 0
    assert got == want


def test_every_query_has_sql():
    assert all(entry.sql for entry in ENTRIES.values())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_has_rows_and_a_stable_schema(spark):
    frame = driver.entry(spark)
    assert frame.count() > 0
    assert frame.columns == ["YEAR", "MONTH", "SEARCH_ENGINE", "SOCIAL_MEDIA", "VIDEO", "EMAIL", "REVENUE"]
