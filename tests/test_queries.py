"""Every registered query next to its comparison SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_queries import rows_of
from tidemark.catalog.views import TABLES

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    names, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(ORACLES[name])
    want_names, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert names == want_names
    assert got == want


def test_entry_and_registry(spark):
    assert set(ORACLES) <= set(QUERIES)
    assert entry.entry(spark).count() > 0
