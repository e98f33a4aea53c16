"""Scalar expressions on inline mini-fixtures (FIXTURES §3, traps T4-T15)."""

import pytest
from pyspark.sql import functions as F

from casegrid.functions import bands, calendar, numbers
from casegrid.operators.cleaning import lookup_district


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_district_names(spark, dims):
    df = spark.createDataFrame(
        [(" NUWARA__eliya ",), ("Kalmune",), ("moneragala",), ("Nuwara-Eliya",), ("Atlantis",), (None,)],
        "name string",
    )
    out = lookup_district(df, "name", dims, display="display", district_id="id", rainfall_area="rain", key="key")
    got = {r["name"]: (r["key"], r["id"], r["display"], r["rain"]) for r in out.collect()}
    assert got[" NUWARA__eliya "] == ("nuwaraeliya", 6, "Nuwara Eliya", "Nuwara Eliya")
    assert got["Kalmune"] == ("kalmunai", 26, "Kalmunai", "Ampara")
    assert got["moneragala"] == ("monaragala", 23, "Monaragala", "Monaragala")
    assert got["Nuwara-Eliya"][1] == 6
    assert got["Atlantis"] == ("atlantis", None, "Atlantis", "Atlantis")
    assert got[None] == ("", None, "nan", "nan")


def test_number_parsing(spark):
    df = spark.createDataFrame([("2,375,415",), ("abc",), ("2.5",), ("3.5",)], "v string")
    out = df.select("v", numbers.parse_thousands("v").alias("p"))
    assert dict(rows(out, "v", "p")) == {"2,375,415": 2375415.0, "abc": None, "2.5": 2.5, "3.5": 3.5}
    ok = df.filter(F.col("v") != "abc").select("v", numbers.strict_int("v").alias("i"))
    assert dict(rows(ok, "v", "i")) == {"2,375,415": 2375415, "2.5": 2, "3.5": 4}
    with pytest.raises(Exception):
        df.filter(F.col("v") == "abc").select(numbers.strict_int("v")).collect()


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-2.5,), (0.125,)], "x double")
    out = df.select("x", numbers.round_half_even("x").alias("r0"), numbers.round_half_even("x", 2).alias("r2"))
    got = {r["x"]: (r["r0"], r["r2"]) for r in out.collect()}
    assert got[2.5][0] == 2.0 and got[1.5][0] == 2.0 and got[0.5][0] == 0.0 and got[-2.5][0] == -2.0
    assert got[0.125][1] == 0.12


def test_week_to_month(spark):
    df = spark.createDataFrame([(w,) for w in (0, 1, 5, 6, 52, 53, 60)], "w int")
    out = df.select("w", calendar.week_to_month("w").alias("m"))
    assert dict(rows(out, "w", "m")) == {0: 1, 1: 1, 5: 1, 6: 2, 52: 12, 53: 12, 60: 12}


def test_month_shift(spark):
    df = spark.createDataFrame([(12, 1), (1, 1), (11, 2)], "m int, lag int")
    out = df.select(calendar.month_shift("m", F.col("lag")).alias("s"))
    assert [r["s"] for r in out.collect()] == [1, 2, 1]


def test_risk_bands(spark):
    df = spark.createDataFrame([(x,) for x in (0.5, 1.0, 3.0, 3.1, 4.0, 4.1, None)], "inc double")
    out = df.select("inc", bands.classify_risk("inc", F.lit(1.0), F.lit(3.0), F.lit(4.0)).alias("b"))
    assert dict(rows(out, "inc", "b")) == {
        0.5: "Below Expected", 1.0: "Normal", 3.0: "Normal", 3.1: "Warning",
        4.0: "Warning", 4.1: "High Risk", None: "Unknown",
    }


def test_lower_threshold_keeps_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0)], "m double, s double")
    out = df.select(bands.lower_threshold("m", "s").alias("lo"))
    assert [r["lo"] for r in out.collect()] == [0.0, None]


def test_lenient_cast_and_divide(spark):
    df = spark.createDataFrame([("x", 0.0), ("5", 2.0)], "c string, p double")
    out = df.select(numbers.lenient_double("c").alias("v"), bands.incidence_per_100k(F.lit(1.0), "p").alias("i"))
    assert rows(out, "v", "i") == [(None, None), (5.0, 50000.0)]


def test_risk_priority(spark):
    df = spark.createDataFrame([("High Risk",), ("Unknown",), ("weird",)], "l string")
    assert [r["p"] for r in df.select(bands.risk_priority("l").alias("p")).collect()] == [4, 0, 0]


def test_cluster_conf_sizes():
    from casegrid.session import cluster_conf

    conf = cluster_conf(8000, input_tb=100)
    assert int(conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) >= 8000 * 4
    assert int(conf["spark.sql.files.maxPartitionBytes"]) == 256 * 1024 * 1024
    assert conf["spark.sql.adaptive.skewJoin.skewedPartitionFactor"] == "5"
