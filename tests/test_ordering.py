"""Row numbers by range partitions."""

from pyspark.sql import functions as F

from casegrid.operators.ordering import with_row_numbers


def rows(spark):
    return spark.range(5000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))).alias("key"),
        F.when(F.col("id") % 11 > 0, (F.col("id") * 7919) % 5003).alias("value"), F.col("id").alias("place"))


def test_whole_table(spark):
    got = with_row_numbers(rows(spark), [F.col("value").desc_nulls_last(), F.col("place")], "n")
    assert got.columns == ["key", "value", "place", "n"]
    got = {r["place"]: r["n"] for r in got.collect()}
    want = sorted(rows(spark).collect(), key=lambda r: (r["value"] is None, -(r["value"] or 0), r["place"]))
    assert got == {r["place"]: i + 1 for i, r in enumerate(want)}


def test_within_a_key(spark):
    df = rows(spark).withColumn("key", F.when(F.col("key") != "k3", F.col("key")))
    got = {r["place"]: r["n"] for r in with_row_numbers(df, [F.col("value").asc_nulls_first(), F.col("place")], "n", ["key"]).collect()}
    want, count = {}, {}
    for r in sorted(df.collect(), key=lambda r: (r["value"] is not None, r["value"] or 0, r["place"])):
        count[r["key"]] = want[r["place"]] = count.get(r["key"], 0) + 1
    assert got == want


def test_no_rows(spark):
    assert with_row_numbers(rows(spark).where("false"), [F.col("value")], "n", ["key"]).count() == 0


def test_no_window_in_one_task(spark):
    plan = with_row_numbers(rows(spark), [F.col("value")])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
