"""Every core query with SQL gives the rows of that SQL."""

import datetime as dt
import glob
import os

import duckdb
import pandas as pd
import pytest

from rostrum.plans import catalog, jobs_catalog  # noqa: F401  # the second adds its queries to the first


def _plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return ""
    if isinstance(v, (dt.date, dt.datetime, pd.Timestamp)):
        return pd.Timestamp(v).isoformat()
    if hasattr(v, "item"):
        v = v.item()
    return str(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def _rows(df):
    return sorted(tuple(_plain(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(name, spark, sf, duck):
    mine, theirs = catalog.QUERIES[name](spark, sf).toPandas(), duck.execute(catalog.ORACLE_SQL[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert _rows(mine) == _rows(theirs)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns
    assert set(entry.oracle_sql()) <= set(entry.queries())
