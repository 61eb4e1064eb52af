"""Queries that SQL can state, against DuckDB on the smallest tables."""

import duckdb
import pytest

from polyglint.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_has_its_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    from check import TABLES, kinds, rows_of

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{FOLDER}/{table}.parquet')")
    got = QUERIES[name](spark, FOLDER).toArrow()
    want = con.sql(ORACLES[name]).to_arrow_table()
    assert kinds(got) == kinds(want)
    assert rows_of(got) == rows_of(want)
