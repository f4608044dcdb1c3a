"""Every registered query against its SQL twin."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from rollcall import catalogue

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLES)
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("key", list(entry_point.oracle_sql()))
def test_same_rows_as_sql(spark, con, key):
    df = entry_point.queries()[key](spark, SF_DIR)
    columns = sorted(df.columns)
    ours = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    names = ", ".join(f'"{c}"' for c in columns)
    result = con.execute(f"SELECT {names} FROM ({entry_point.oracle_sql()[key]})")
    assert ours == sorted(repr(r) for r in result.fetchall())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["department", "job", "Q1", "Q2", "Q3", "Q4"]
    assert df.count() > 0
