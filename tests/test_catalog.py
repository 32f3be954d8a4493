"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from tidemark import catalog
from tidemark.sources.layouts import BENCH_TABLES

FOLDER = "/root/testdata/sf0.001"
QUERIES = catalog.load()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in BENCH_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, oracle, name):
    got = entry_module.queries()[name](spark, FOLDER).toArrow()
    want = oracle.sql(entry_module.oracle_sql()[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    columns = sorted(got.column_names)

    def rows(table):
        return sorted(map(repr, zip(*[table.column(c).to_pylist() for c in columns])))

    assert rows(got) == rows(want)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_module.oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).count() == 50
