"""Every query has a name of its own; a few run against their SQL twins on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point

FOLDER = "/root/testdata/sf0.001"
SAMPLE = ["a10_crosstab_pct", "a22_box_stats", "tx11_clean_text", "e1_tfidf_long", "m11_full_report", "d4_knn_graph", "stage_features"]


def test_every_oracle_belongs_to_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() == 3


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    from check import TABLES, rows_of

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{FOLDER}/{table}.parquet')")
    got = entry_point.queries()[name](spark, FOLDER).toArrow()
    want = con.execute(entry_point.oracle_sql()[name]).to_arrow_table()
    assert rows_of(got) == rows_of(want)
