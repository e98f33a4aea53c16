"""Files written and read back, previews, unseen levels, and the wide pivot."""

import hashlib
import warnings

import pytest
from pyspark.sql import functions as F

from casegrid.functions.numbers import clip_zero_int, lenient_int, to_int_half_even
from casegrid.operators import forecast, patterns, rainfall
from casegrid.plans.round_trips import csv_sums, table_sums
from casegrid.sources import files, sinks


def test_case_files_keep_spaces_and_blanks(spark, workdir):
    rows = spark.createDataFrame(
        [(2023, "Dengue Fever", "1", " A-b ", ""), (2023, "Dengue Fever", "2", "C, d", "5"), (2024, "TB", "3", "E", None)],
        "year int, disease string, week_number string, area_reported string, cases_reported string")
    for kind in ({"quote_all": True}, {"bom": True}, {"columns": ["cases_reported", "area_reported", "week_number"]}):
        folder = f"{workdir}/{'-'.join(kind)}"
        paths = sinks.write_case_files(rows, folder, **kind)
        assert [p.rsplit("/", 1)[1] for p in paths] == ["2023_Dengue Fever.csv", "2024_TB.csv"]
        got = files.read_case_files(spark, paths)
        got = got.select("year", "disease", "week_number", "area_reported", F.coalesce("cases_reported", F.lit("")))
        assert sorted(map(tuple, got.collect())) == [(2023, "Dengue Fever", "1", " A-b ", ""), (2023, "Dengue Fever", "2", "C, d", "5"), (2024, "TB", "3", "E", "")]
        with pytest.raises(FileExistsError):
            sinks.write_case_files(rows, folder, **kind)
    with pytest.raises(ValueError):
        sinks.write_case_files(rows, f"{workdir}/both", bom=True, quote_all=True)
    with warnings.catch_warnings(record=True):
        assert files.read_case_files(spark, [*paths, f"{workdir}/1999_TB.csv"], "skip").count() == 3
    with pytest.raises(FileNotFoundError):
        files.read_case_files(spark, [*paths, f"{workdir}/1999_TB.csv"], "error")


def test_preview_is_ordered(spark, workdir):
    df = spark.range(500).select((499 - F.col("id")).alias("a"))
    assert [r["a"] for r in files.preview(df, 3, ["a"])[1].collect()] == [0, 1, 2]
    path = sinks.write_table(df, f"{workdir}/t", order_by=["a"])
    got = files.read_in_order(spark, path, "a long")
    assert got.where("a + 1 <> row_number").count() == 0 and got.count() == 500


def test_numbers_that_no_int_holds(spark):
    df = spark.createDataFrame([("1e12",), ("3.7",), ("-3.7",), ("x",), ("",), (None,), ("2147483647",)], "t string")
    assert [r[0] for r in df.select(lenient_int("t")).collect()] == [None, 3, -3, None, None, None, 2147483647]
    big = spark.createDataFrame([(1e12,), (2.5,), (-1e12,)], "x double")
    assert [tuple(r) for r in big.select(to_int_half_even("x"), clip_zero_int("x")).collect()] == [(None, None), (2, 2), (None, 0)]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(2000 + y, w, 1 + w % 12, 100.0, 50.0, a, d, float(w + 10 * (a == "B") + 20 * (d == "Y"))) for y in range(2) for w in range(1, 20) for a in "ABC" for d in "XY"]
    data = spark.createDataFrame(rows, "year int, week_number int, month int, avg_annual_rainfall_mm double, national_avg_rainfall_mm double, area_reported string, disease string, cases_reported double")
    return forecast.build_pipeline(5, 6).fit(data), data


def test_unseen_levels_are_the_baseline(spark, model):
    fitted, data = model
    for column, baseline in (("area_reported", "A"), ("disease", "X")):
        rows = data.where(F.col(column) == baseline)
        want = forecast.predict(fitted, rows).drop(column)
        for unknown in (F.lit("Z"), F.lit(None).cast("string")):
            got = forecast.predict(fitted, rows.withColumn(column, unknown))
            assert sorted(map(repr, got.drop(column).collect())) == sorted(map(repr, want.collect()))
            assert got.where(F.col(column).eqNullSafe(unknown)).count() == rows.count()
    assert forecast.predict(fitted, data).select("area_reported", "disease").distinct().count() == 6


def test_categories_from_feature_names(model):
    names = forecast.feature_columns(model[0])
    assert names == [*forecast.NUMERIC, "area_reported_C", "area_reported_B", "disease_Y"]
    assert forecast.categories_from_features(names, ["X", "Y"]) == (["B", "C"], ["X", "Y"])
    assembled = model[0].transform(model[1]).schema["features"].metadata["ml_attr"]["num_attrs"]
    assert assembled == len(names)


def test_wide_pivot_and_its_cells(spark):
    yoy = spark.createDataFrame([("X", 2000, 5.0), ("X", 2001, 7.0), ("Y", 2001, 1.0)], "disease string, year int, total_cases double")
    wide = patterns.annual_pivot(yoy)
    assert wide.columns == ["disease", "2000", "2001"]
    assert sorted(map(tuple, wide.collect())) == [("X", 5, 7), ("Y", 0, 1)]
    assert sorted(map(tuple, patterns.annual_grid(yoy).collect())) == [("X", 2000, 5), ("X", 2001, 7), ("Y", 2000, 0), ("Y", 2001, 1)]


def test_ranks_are_no_work_of_one_task(spark):
    monthly = spark.range(100).select(F.concat(F.lit("d"), F.col("id") % 30).alias("district"), (F.col("id") % 7).cast("double").alias("avg_rainfall_mm"))
    ranked = rainfall.district_totals_ranked(monthly)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 31))


def test_table_sums(spark, workdir):
    kinds = [("a", "string"), ("x", "double"), ("n", "int")]
    df = spark.createDataFrame([("p", 0.1, 1), ("p", 0.2, None), (None, 1e-9, 3), ("q", None, 2)], "a string, x double, n int")
    rows = {r["column"]: tuple(r)[2:] for r in table_sums("t", df, kinds, ("n",)).collect()}
    parts = [int(hashlib.md5(t).hexdigest()[:8], 16) for t in (b"p", b"q")]
    assert rows == {"a": (4, 3, 2.0 * parts[0] + parts[1]), "x": (4, 3, 0.3), "n": (4, 3, None)}
    path = sinks.write_table(df, f"{workdir}/sums", order_by=["n"])
    again = {r["column"]: tuple(r)[2:] for r in csv_sums(spark, path, "t", kinds).collect()}
    assert again == {**rows, "n": (4, 3, 6.0)}
    assert [tuple(r) for r in table_sums("t", df.limit(0), kinds).collect()] == [("t", c, 0, 0, None) for c, _ in kinds]
