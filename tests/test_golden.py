"""Golden values measured on the original surveillance CSV files (FIXTURES §2).

Set CASEGRID_SURVEILLANCE_DIR to a folder with the nine case files, the
population file and the rainfall file to run these checks.
"""

import os

import pytest
from pyspark.sql import functions as F

from casegrid.plans import jobs

DATA = os.environ.get("CASEGRID_SURVEILLANCE_DIR")
pytestmark = pytest.mark.skipif(not DATA, reason="CASEGRID_SURVEILLANCE_DIR not set")


@pytest.fixture(scope="module")
def inputs(spark):
    return jobs.surveillance_inputs(spark, DATA)


def test_thresholds_2024(inputs):
    r = jobs.risk_job(inputs, year=2024)
    thr = r["thresholds"]
    assert thr.count() == 78
    first = thr.filter((F.col("disease") == "Dysentery") & (F.col("area_reported") == "Ampara")).first()
    assert abs(first["mean_incidence"] - 0.10589758639254242) < 1e-12
    assert abs(first["std_incidence"] - 0.11074309383042014) < 1e-12
    assert abs(first["outbreak_threshold"] - 0.3273837740533827) < 1e-12
    assert first["weeks"] == 52 and first["population"] == 744551
    counts = {(r["disease"], r["risk_level"]): r["count"]
              for r in r["weekly_risk"].groupBy("disease", "risk_level").count().collect()}
    assert counts[("Dysentery", "Normal")] == 1114 and counts[("Dysentery", "High Risk")] == 61
    assert counts[("Meningitis", "Below Expected")] == 113 and counts[("Tuberculosis", "Warning")] == 120
    assert r["risk_rows"].count() == 78 * 52 - 26  # Tuberculosis 2024 has 51 weeks


def test_analytics_tables(spark, inputs):
    a = jobs.analytics_job(spark, inputs)
    assert a["frame"].count() == 11310
    assert a["frame"].filter(F.col("rainfall_mm").isNotNull()).count() == 10875
    annual = {r["disease"]: (r["2023"], r["2024"], r["2025"]) for r in a["summary_annual_cases"].collect()}
    assert annual["Dysentery"] == (1272, 1299, 1024) and annual["Tuberculosis"] == (9167, 9077, 9379)
    top = [r["district"] for r in a["summary_top_hotspots"].filter("disease = 'Meningitis'").orderBy("rank").collect()]
    assert top == ["Kurunegala", "Gampaha", "Ratnapura", "Kegalle", "Galle"]
    lag = {r["disease"]: (r["lag_0mo"], r["lag_1mo"], r["lag_2mo"]) for r in a["summary_lagged_correlation"].collect()}
    assert lag["Dysentery"] == (0.124, 0.107, 0.02)
    peak = a["rainfall_peak_months"].filter("district = 'Kalutara'").first()
    assert peak["peak_month"] == "May"
