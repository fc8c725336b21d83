"""Every registered query next to its checking SQL, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from check import TABLES, normal
from restframe.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def tables(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["o_orderkey", "c_name", "c_mktsegment"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, sf_dir, name):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    cursor = tables.execute(entry.oracle_sql()[name])
    want = pd.DataFrame(cursor.fetchall(), columns=[d[0] for d in cursor.description])
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got)
    assert normal(got) == normal(want)
