"""Every query with an SQL equivalent against an independent engine, on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from gridcast.workloads import batch, oracles

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["customer", "events", "lineitem", "orders", "part"]
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp": "TIMESTAMP",
         "boolean": "BOOLEAN"}
ORACLES = oracles.build()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return c


def rows(pdf, kinds):
    def cell(x, kind):
        if x is None or x is pd.NaT or (isinstance(x, float) and math.isnan(x)) or pd.isna(x):
            return "~"
        if kind in ("BIGINT", "INTEGER"):
            return str(int(x))
        return repr(float(x)) if kind == "DOUBLE" else str(pd.Timestamp(x)) if kind == "TIMESTAMP" else str(x)

    names = sorted(pdf.columns)
    return sorted(tuple(cell(x, kinds[n]) for n, x in zip(names, r)) for r in pdf[names].astype(object).itertuples(index=False))


def test_every_query_has_sql():
    assert set(batch.QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = entry_points.queries()[name](spark, SF_DIR)
    want = duck.sql(ORACLES[name])
    kinds = {c: KINDS[t] for c, t in got.dtypes}
    assert kinds == dict(zip(want.columns, map(str, want.types)))
    assert rows(got.toPandas(), kinds) == rows(want.df(), kinds)


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["site", "timestamp", "aqi", "aqi_roll_mean_24h"]
