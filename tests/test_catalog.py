"""Each query against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from recordmill import catalog

SF = "/root/testdata/sf0.001"


def rows(df):
    names = sorted(df.columns)
    return sorted(tuple(f"{v:.6f}" if isinstance(v, float) else str(None if pd.isna(v) else v) for v in r) for r in df[names].astype(object).values.tolist())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not there")
@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, con, name):
    got, want = catalog.QUERIES[name](spark, SF).toPandas(), con.sql(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
