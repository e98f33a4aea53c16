"""The forest's node table."""

import pytest
from pyspark.sql import functions as F

from casegrid.operators import forecast, forest_table


@pytest.fixture(scope="module")
def fitted(spark):
    rows = [(2000 + y, w, 1 + w % 12, 100.0 + w % 3, 50.0, a, d, float(w * w % 17 + 10 * (a == "B") + 20 * (d == "Y")))
            for y in range(2) for w in range(1, 30) for a in "ABC" for d in "XY"]
    data = spark.createDataFrame(rows, "year int, week_number int, month int, avg_annual_rainfall_mm double, national_avg_rainfall_mm double, area_reported string, disease string, cases_reported double")
    return forecast.build_pipeline(4, 12).fit(data), data


def test_scores_are_the_models(spark, fitted, workdir):
    model, data = fitted
    nodes = forest_table.forest_nodes(spark, forecast.save_model(model, f"{workdir}/m"))
    forest = model.stages[-1]
    assert nodes.count() == forest.totalNumNodes and nodes.select("tree").distinct().count() == 4
    given = forecast.transform(model, data.unionByName(data.limit(5))).withColumnRenamed("prediction", "want")
    got = forest_table.score_by_nodes(given, nodes, 12)  # deeper than one step of levels
    assert got.count() == given.count() and got.where(F.col("prediction") != F.col("want")).count() == 0
    assert forest_table.score_by_nodes(given.where("false"), nodes, 12).count() == 0


def test_splits_lead_to_all_rows(spark, fitted, workdir):
    nodes = forest_table.forest_nodes(spark, forecast.save_model(fitted[0], f"{workdir}/m2"))
    inner = nodes.where("feature IS NOT NULL").alias("p")
    for side in ("left", "right"):
        assert inner.join(nodes.alias("c"), (F.col("p.tree") == F.col("c.tree")) & (F.col(f"p.{side}") == F.col("c.node"))).count() == inner.count()
    assert nodes.where("feature IS NOT NULL AND (threshold IS NULL) = (categories IS NULL)").count() == 0
    assert nodes.where("feature IS NULL AND (left <> node OR right <> node)").count() == 0
