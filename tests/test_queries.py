"""Every query that SQL can say gives the SQL's rows on the smallest tables."""

import numbers

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df):
    df = df[sorted(df.columns)]
    cell = lambda v: "null" if v is None or (not hasattr(v, "__len__") and pd.isna(v)) else f"{v + 0.0:.5f}" if isinstance(v, numbers.Number) and not isinstance(v, bool) else str(v)
    return sorted(tuple(cell(v) for v in r) for r in df.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_sql(spark, duck, name):
    ours, theirs = entry.queries()[name](spark, SF).toPandas(), duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
