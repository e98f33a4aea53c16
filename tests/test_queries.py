"""Every registered query against its DuckDB oracle on the smallest test tables."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from casegrid.oracle_files import SQL
from casegrid.plans.round_trips import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _digest(cols, rows):
    def norm(v):
        if v is None:
            return "NULL"
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else repr(v + 0.0)
        return repr(v)

    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "orders", "lineitem"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "risk_level" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = SQL.get(name)
    if sql is None:
        assert len(rows) > 0
        return
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _digest(df.columns, rows) == _digest(dcols, drows)


def test_entry_schema_is_stable(spark):
    first = entry.entry(spark).schema.simpleString()
    second = entry.entry(spark).schema.simpleString()
    assert first == second
    assert first.startswith("struct<year:int,disease:string,week_number:int,area_reported:string")


def test_entry_has_every_query():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
