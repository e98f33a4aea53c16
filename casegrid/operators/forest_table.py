"""The fitted forest as a table of nodes, scored by joins.

A saved forest is a Parquet table with a row for each node of each tree. ``forest_nodes`` reads
it as a plain DataFrame: a model can be looked into, compared and versioned like any table, and
``score_by_nodes`` evaluates it with one join per level, without Spark ML's model object. Which
side of a join is broadcast is left to its measured size.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.session import materialize

#: Levels that are planned as one query; between such steps the rows are written once.
LEVELS_AT_ONCE = 10


def forest_nodes(spark: SparkSession, model_dir: str) -> DataFrame:
    """``tree, node, prediction, feature, threshold, categories, left, right, rows`` of a saved pipeline's forest.

    ``feature`` is NULL for a leaf, whose ``left`` and ``right`` are the leaf itself. ``threshold`` is
    NULL where the split is on ``categories``.
    """
    saved = spark.read.parquet(f"{model_dir.rstrip('/')}/stages/*_RandomForestRegressor_*/data")
    split, node = F.col("nodeData.split"), F.col("nodeData.id")
    leaf = F.col("nodeData.leftChild") < 0
    of_categories = split["numCategories"] >= 0
    values = split["leftCategoriesOrThreshold"]
    return saved.select(
        F.col("treeID").alias("tree"), node.alias("node"), F.col("nodeData.prediction").alias("prediction"),
        F.when(~leaf, split["featureIndex"]).alias("feature"),
        F.when(~leaf & ~of_categories, F.get(values, F.lit(0))).alias("threshold"),
        F.when(~leaf & of_categories, values).alias("categories"),
        F.when(leaf, node).otherwise(F.col("nodeData.leftChild")).alias("left"),
        F.when(leaf, node).otherwise(F.col("nodeData.rightChild")).alias("right"),
        F.col("nodeData.rawCount").alias("rows"),
    )


def score_by_nodes(rows: DataFrame, nodes: DataFrame, depth: int, features_col: str = "features", prediction_col: str = "prediction") -> DataFrame:
    """All columns of ``rows`` and the mean of the trees' leaves, added in the order of the trees as the model does.

    ``depth``: the trees' greatest depth at most. A row stands once for each tree while it goes down; rows and
    trees are dealt by (tree, node), the sums by row.
    """
    numbered = materialize(rows.withColumn("__row", F.monotonically_increasing_id()), "forest-rows")
    trees = sorted(r["tree"] for r in nodes.select("tree").distinct().collect())  # as many as the forest has
    each = F.explode(F.array(*[F.lit(t) for t in trees]))
    state = numbered.select("__row", vector_to_array(features_col).alias("__x"), each.alias("tree"), F.lit(0).alias("node"))
    value = F.get(F.col("__x"), F.col("feature"))
    goes_left = F.coalesce(F.when(F.col("categories").isNotNull(), F.array_contains("categories", value)).otherwise(value <= F.col("threshold")), F.lit(True))
    for level in range(depth):
        if level and level % LEVELS_AT_ONCE == 0:
            state = materialize(state, "forest-level")
        at = state.join(nodes.select("tree", "node", "feature", "threshold", "categories", "left", "right"), ["tree", "node"])
        state = at.select("__row", "__x", "tree", F.when(goes_left, F.col("left")).otherwise(F.col("right")).alias("node"))
    leaves = state.drop("__x").join(nodes.select("tree", "node", "prediction"), ["tree", "node"])
    votes = leaves.groupBy("__row").agg(F.array_sort(F.collect_list(F.struct("tree", "prediction"))).alias("__votes"))  # as many as trees
    total = F.aggregate("__votes", F.lit(0.0), lambda acc, v: acc + v["prediction"])
    scored = votes.select("__row", (total / F.size("__votes")).alias(prediction_col))
    return numbered.drop(prediction_col).join(scored, "__row").drop("__row")
