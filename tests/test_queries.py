"""Every registered query with SQL against DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


def canonical(df):
    def one(x):
        if x is None or (isinstance(x, float) and math.isnan(x)) or str(x) in ("NaT", "<NA>"):
            return "null"
        return repr(round(float(x), 6)) if isinstance(x, int | float) or type(x).__module__ == "numpy" and getattr(x, "ndim", 1) == 0 else str(x)

    return sorted(tuple(one(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_against_sql(spark, duck, name):
    got, want = entry.queries()[name](spark, DIR).toPandas(), duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
