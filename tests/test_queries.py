"""Every registered query with SQL, held against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import queries as plans

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()


def rows(frame):
    frame = frame[sorted(frame.columns)]
    cell = lambda x: "NULL" if x is None or str(x) in ("nan", "NaT", "<NA>") else repr(float(x)) if isinstance(x, float) and not math.isnan(x) else str(x)
    return sorted(tuple(map(cell, r)) for r in frame.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(plans.QUERIES))
def test_query(spark, duck, name):
    got = plans.QUERIES[name](spark, DIR).toPandas()
    want = duck.execute(plans.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(plans.QUERIES) <= set(entry.queries()) and set(plans.SQL) <= set(entry.oracle_sql())
