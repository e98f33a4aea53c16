"""The operators' DuckDB SQL over the smallest tables, and the plan of the native operator."""

import os

import duckdb
import pytest

from casegrid.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in found.description]
    df = queries.QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(repr, found.fetchall())) == sorted(repr(tuple(r)) for r in df.select(*columns).collect())


def test_chat_is_native(spark):
    plan = queries.op7_chat(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
