"""Plan guards: properties the physical plan of every surveillance query must keep."""

import os

import pytest
from pyspark.sql import functions as F

from casegrid.operators import upsert
from casegrid.plans.edge_cases import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = (
    "CartesianProduct",          # no cross joins
    "BroadcastNestedLoopJoin",   # no non-equi pair generation
    "BatchEvalPython",           # no row-at-a-time Python UDFs
    "ArrowEvalPython",           # no pandas UDFs in the hot path
    "FlatMapGroupsInPandas",     # no group collected into one pandas frame
)
SKIP = {"forecast_metrics", "forecast_predictions"}  # they fit a model while building


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_plan_has_no_forbidden_operators(spark, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name} uses {op}"


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_scans_are_pruned(spark):
    plan = QUERIES["weekly_risk_levels"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_hot_key_dedup_is_a_partial_aggregate(spark):
    # one key holds a third of the batch: the last-row-wins step must combine it map-side
    rows = [("hot", i, i) for i in range(300)] + [(f"k{i}", i, i) for i in range(600)]
    batch = spark.createDataFrame(rows, "k string, v int, seq int")
    target = spark.createDataFrame([("hot", -1, "id-hot")], "k string, v int, id string")
    merged = upsert.merge_upsert(target, batch, ["k"], ["v"], id_col="id", seq_col="seq")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan
    got = merged.filter(F.col("k") == "hot").first()
    assert got["v"] == 299 and got["id"] == "id-hot"
    assert merged.count() == 601
