"""Every query with SQL gives the same rows as DuckDB at the smallest size."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from chatloom.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return round(v, 6)
    return int(v) if hasattr(v, "__index__") else str(v)


def rows(df, columns):
    return sorted(repr(tuple(plain(v) for v in r)) for r in df[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DATA)
    want = duck.sql(catalogue.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.toPandas(), sorted(got.columns)) == rows(want, sorted(got.columns))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
