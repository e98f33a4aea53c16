"""Load reports, key checks and small lookups."""

from casegrid.dims import PROVINCES, province_frame
from casegrid.operators import cleaning, loads, risk
from casegrid.sources import checks, files


def raw_cases(spark):
    return spark.createDataFrame(
        [
            ("2024", "Dysentery", "1", "Colombo", "3"),
            ("2024", "dysentery ", "2", "NuwaraEliya", "1"),
            ("2024", "Dysentery", "3", "Atlantis", "2"),
            ("2024", "Cholera", "1", "Colombo", "5"),
            ("2024", "Dysentery", "4", "Colombo", ""),
        ],
        "year string, disease string, week_number string, area_reported string, cases_reported string",
    )


def test_load_report_counts_unknowns(spark, dims):
    rows = loads.keyed_case_rows(raw_cases(spark), dims)
    overall = loads.load_report(rows, by=None).first()
    assert overall["rows"] == 4  # the blank count is dropped before the report
    assert overall["skipped_unknown_district"] == 1 and overall["skipped_unknown_disease"] == 1
    assert overall["accepted"] == 2
    assert loads.accepted(rows).count() == 2
    by = {r["disease"]: r["rows"] for r in loads.load_report(rows).collect()}
    assert by == {"Dysentery": 3, "Cholera": 1}


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    assert [(r["k"], r["n"]) for r in loads.duplicate_keys(df, ["k", "v"]).collect()] == [(1, 2)]


def test_unmatched_areas_and_invalid_population(spark, dims):
    cases = cleaning.clean_cases(raw_cases(spark), dims, "zero")
    pop = cleaning.clean_population(
        spark.createDataFrame([("Colombo", "2,375,415"), ("Nuwara Eliya", "n/a")], "Region string, Population string"),
        dims, keep_invalid=True,
    )
    unmatched = sorted(r["district"] for r in risk.unmatched_areas(cases, pop).collect())
    assert unmatched == ["Atlantis", "Nuwara Eliya"]
    assert [r["district"] for r in cleaning.null_rows(pop, "population").collect()] == ["Nuwara Eliya"]


def test_province_lookup(spark):
    df = spark.createDataFrame([("Colombo",), ("Kalmunai",), ("Atlantis",)], "district string")
    out = {r["district"]: (r["province"], r["sort_order"])
           for r in cleaning.with_province(df, province_frame(spark, PROVINCES)).collect()}
    assert out["Colombo"] == ("W", 1) and out["Kalmunai"][0] == "E" and out["Atlantis"] == (None, None)


def test_schema_helpers_and_preview(spark):
    df = spark.createDataFrame([(1, "x")], "id long, Area string")
    assert checks.pick_existing_column(df, ["District", "Area"]) == "Area"
    assert checks.is_integer_type(checks.column_type(df, "id"))
    assert checks.column_type(df, "missing") is None
    try:
        checks.require_columns(df, ["id", "District", "Jan"])
    except checks.MissingColumnsError as exc:
        assert "District" in str(exc) and "Jan" in str(exc)
    n, head = files.preview(df)
    assert n == 1 and head.count() == 1


def test_legacy_population_key(spark, dims):
    raw = spark.createDataFrame(
        [("Nuwara Eliya", "706,588"), ("Moneragala", "1"), ("Nuwara_Eliya", "5"), (None, "3")],
        "Region string, Population string",
    )
    got = [(r["district_id"], r["population"]) for r in loads.legacy_population_rows(raw, dims).collect()]
    assert sorted(got, key=lambda x: (x[0] is None, x)) == [(6, 706588), (23, 1), (None, 3), (None, 5)]
    rep = loads.population_report(raw, dims).first()
    assert rep["rows"] == 4 and rep["skipped_unknown_district"] == 1
