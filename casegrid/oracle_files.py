"""DuckDB SQL of the queries that go through files (``casegrid.plans.round_trips``).

Importing this module adds them to ``oracle_edges.SQL``.
"""

from __future__ import annotations

from casegrid.oracle import _FEATURES, _KEYED, _LONG, _RAIN_ROWS, _RISK_ROWS, MONTH_ORDER, r6, r9, with_analytics, with_base
from casegrid.oracle_edges import SQL

__all__ = ["SQL"]

SQL["case_files"] = with_base("""
SELECT year, disease, week_number, area_reported, nullif(cases_reported, '') AS cases_reported FROM raw_cases
""")

SQL["clean_case_files"] = with_base("SELECT * FROM clean_zero")

_MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
SQL["input_files"] = with_analytics(
    "SELECT Region AS area, 'Population' AS \"column\", Population AS value FROM raw_population UNION ALL "
    + " UNION ALL ".join(f"SELECT District, '{c}', CAST({c} AS VARCHAR) FROM rain_wide" for c in [*_MONTHS, "Annual"])
)

SQL["prediction_files"] = with_base("""
SELECT w.week_number, 2002 AS year, d.district_id, s.disease_id, CAST(round_even(avg(w.cases_reported), 0) AS INTEGER) AS case_count
FROM clean_drop w JOIN districts d ON d.district_display = w.district JOIN diseases s ON s.disease_display = w.disease
GROUP BY w.week_number, d.district_id, s.disease_id
""")

SQL["clean_cases_bad_weeks"] = with_base("""
SELECT year, disease, district, week_number, month, cases_reported FROM clean_zero WHERE week_number % 10 NOT IN (1, 2, 4)
""")

SQL["weekly_risk_order"] = with_base("""
SELECT year, disease, week_number, area_reported, risk_level,
       row_number() OVER (ORDER BY year, disease, week_number, area_reported) AS row_number
FROM weekly_risk
""")

SQL["hotspot_order"] = with_base("""
SELECT disease, district, total_cases, row_number() OVER (ORDER BY disease, total_cases DESC, district) AS row_number,
       row_number() OVER (PARTITION BY disease ORDER BY total_cases DESC, district) AS rank
FROM (SELECT disease, district, sum(cases_reported) AS total_cases FROM clean_drop GROUP BY 1, 2)
""")

SQL["preview_rows"] = with_base("""
SELECT w.year, s.disease_id, w.week_number, d.district_id, w.risk_level, count(*) OVER () AS rows
FROM weekly_risk w JOIN districts d ON d.district_display = w.area_reported JOIN diseases s ON s.disease_display = w.disease
ORDER BY w.year, s.disease_id, w.week_number, d.district_id LIMIT 5
""")

SQL["unseen_levels"] = with_analytics("""
SELECT CAST(w.range AS INTEGER) AS week_number, 'Elsewhere' AS area_reported, s.disease, TRUE AS as_baseline
FROM range(1, 53) w CROSS JOIN (SELECT DISTINCT disease FROM train_rows) s
UNION ALL
SELECT CAST(w.range AS INTEGER), a.area_reported, 'Q', TRUE
FROM range(1, 53) w CROSS JOIN (SELECT DISTINCT area_reported FROM train_rows) a
""", _FEATURES)

SQL["forest_table"] = with_analytics("""
SELECT CAST(w.range AS INTEGER) AS week_number, a.area_reported, s.disease, TRUE AS as_fitted, TRUE AS as_loaded
FROM range(1, 53) w CROSS JOIN (SELECT DISTINCT area_reported FROM train_rows) a CROSS JOIN (SELECT DISTINCT disease FROM train_rows) s
""", _FEATURES)

SQL["upsert_cycle"] = with_base("""
SELECT week_number, year, district_id, disease_id,
       CASE WHEN year >= 1998 AND week_number <= 26 THEN case_count + 1 ELSE case_count END AS case_count,
       CAST(NULL AS INTEGER) AS step, CAST(NULL AS BIGINT) AS inserted, CAST(NULL AS BIGINT) AS updated, CAST(NULL AS BIGINT) AS unchanged
FROM hist WHERE year <= 1998 OR week_number <= 26
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, 1, count(*) FILTER (year <= 1998), 0, 0 FROM hist
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, 2, count(*) FILTER (year > 1998 AND week_number <= 26), count(*) FILTER (year = 1998 AND week_number <= 26),
       count(*) FILTER (year = 1998 AND week_number > 26) FROM hist
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, 3, 0, count(*) FILTER (year >= 1998 AND week_number <= 26), count(*) FILTER (year = 1998 AND week_number > 26) FROM hist
""", _KEYED)

_POPULATION = "SELECT d.district_id, CAST(round_even(p.population, 0) AS INTEGER) AS population FROM population p JOIN districts d ON d.district_display = p.district WHERE p.population IS NOT NULL"
SQL["population_swap"] = with_base(f"""
SELECT district_id, CASE WHEN district_id % 2 = 0 THEN population + 1 ELSE population END AS population,
       CAST(NULL AS INTEGER) AS step, CAST(NULL AS BIGINT) AS inserted, CAST(NULL AS BIGINT) AS updated, CAST(NULL AS BIGINT) AS unchanged
FROM ({_POPULATION})
UNION ALL SELECT NULL, NULL, 1, count(*), 0, 0 FROM ({_POPULATION})
UNION ALL SELECT NULL, NULL, 2, 0, count(*) FILTER (district_id % 2 = 0), count(*) FILTER (district_id % 2 = 1) FROM ({_POPULATION})
""")

SQL["integer_ids"] = with_base("""
SELECT week_number, year, district_id, disease_id, row_number() OVER (ORDER BY week_number, year, district_id, disease_id) AS data_id, 'update' AS action
FROM hist WHERE year <= 1995
UNION ALL
SELECT NULL, NULL, NULL, NULL, (SELECT count(*) FROM hist WHERE year <= 1995) + row_number() OVER (), 'insert' FROM hist WHERE year > 1995
""", _KEYED)

SQL["late_corrections"] = with_base("""
SELECT week_number, year, district_id, disease_id,
       CASE WHEN week_number > 26 THEN case_count WHEN case_count IS NULL THEN 7 ELSE case_count + 1 END AS case_count,
       CAST(NULL AS INTEGER) AS step, CAST(NULL AS BIGINT) AS inserted, CAST(NULL AS BIGINT) AS updated, CAST(NULL AS BIGINT) AS unchanged
FROM dropped WHERE week_number <= 26 OR case_count IS NOT NULL
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, 1, count(case_count), 0, 0 FROM dropped
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, 2, 0, 0, 0
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, 3, count(*) FILTER (week_number <= 26 AND case_count IS NULL), count(case_count) FILTER (week_number <= 26),
       count(case_count) FILTER (week_number > 26 AND year IN (SELECT year FROM dropped WHERE week_number <= 26)) FROM dropped
""", """
dropped AS (
  SELECT week_number, year, district_id, disease_id, CAST(round_even(cases_raw, 0) AS INTEGER) AS case_count FROM parsed_cases
  WHERE year IS NOT NULL AND week_number IS NOT NULL AND district_id IS NOT NULL AND disease_id IS NOT NULL
)
""")


# ---------------------------------------------------------------- whole jobs


def table_sums(table: str, rows: str, numbers: str, texts: str = "", unsummed: str = "", digits: int = 6) -> str:
    """Rows, filled cells and sum of each column (names separated by spaces) of the query ``rows``."""
    rounded = {6: r6, 9: r9}[digits]
    total = {c: f"SUM(CAST({rounded(f'CAST({chr(34)}{c}{chr(34)} AS DOUBLE)')} AS DECIMAL(28,{digits})))" for c in numbers.split()}
    total |= {c: f"SUM(CAST('0x' || substr(md5(\"{c}\"), 1, 8) AS BIGINT))" for c in texts.split()}
    total |= {c: "NULL" for c in unsummed.split()}
    sums = ", ".join(f"{{'column': '{c}', 'filled': count(\"{c}\"), 'total': CAST({t} AS DOUBLE)}}" for c, t in total.items())
    return f"SELECT '{table}' AS \"table\", s['column'] AS \"column\", rows, s.filled AS filled, s.total AS total FROM (SELECT count(*) AS rows, unnest([{sums}]) AS s FROM ({rows}))"


_MONTHS_TEXT = " ".join(MONTH_ORDER)
_ANALYTICS_TABLES = [
    ("disease_hotspots", "hotspots", "year total_cases population incidence_per_100k", "disease district"),
    ("disease_seasonality", "seasonality", "year week_number total_cases mean_cases_per_district", "disease"),
    ("disease_monthly", "monthly_profile", "month total_cases mean_cases", "disease"),
    ("disease_yoy", "yoy_change", "year total_cases yoy_pct_change", "disease"),
    ("rainfall_monthly_by_district", "rain_monthly", "month avg_rainfall_mm", "district month_name"),
    ("rainfall_district_totals", "rain_totals_ranked", "annual_rainfall_mm rank", "district"),
    ("rainfall_peak_months", "rain_peak_month", "peak_rainfall_mm", "district peak_month"),
    ("rainfall_heatmap", "rain_heatmap", _MONTHS_TEXT, "district"),
    ("rain_disease_correlation", "rain_case_corr", "correlation n_weeks", "disease district"),
    ("rain_disease_lagged_correlation", "rain_case_corr_lagged", "lag_months correlation n_weeks", "disease district"),
    ("correlation_distribution", "corr_distribution", "mean_r min_r q1_r median_r q3_r max_r", "disease"),
    ("lagged_correlation_summary", "lag_summary", "lag_months mean_corr std_corr mean_corr_3dp", "disease"),
    ("summary_top_hotspots", "top_hotspots", "total_cases rank", "disease district"),
    ("summary_rainfall_extremes", "rain_extremes", "annual_rainfall_mm rank", "label district"),
    ("summary_correlation", "corr_summary", "mean_r median_r n_districts", "disease"),
    ("summary_lagged_correlation", "lag_pivot", "lag_0mo lag_1mo lag_2mo", "disease"),
]
#: The wide table has a column for each year; its SQL is the long form's.
_ANNUAL = f"""
SELECT 'summary_annual_cases' AS "table", CAST(year AS VARCHAR) AS "column", count(*) AS rows, count(*) AS filled, CAST(SUM(total_cases) AS DOUBLE) AS total
FROM ({SQL["annual_pivot"]}) GROUP BY year
UNION ALL
{table_sums("summary_annual_cases", f"SELECT DISTINCT disease FROM ({SQL['annual_pivot']})", "", "disease")}
"""
SQL["analytics_job_tables"] = "\nUNION ALL\n".join([table_sums(t, SQL[q], n, x, digits=9 if q in ("corr_distribution", "lag_summary", "corr_summary") else 6) for t, q, n, x in _ANALYTICS_TABLES] + [_ANNUAL])

_REPORTS = with_analytics("""
SELECT CAST(w.range AS INTEGER) AS week_number, 2002 AS year, d.district_id, s.disease_id, 0 AS case_count
FROM range(1, 53) w CROSS JOIN (SELECT DISTINCT area_reported FROM train_rows) a CROSS JOIN (SELECT DISTINCT disease FROM train_rows) t
JOIN districts d ON d.district_display = a.area_reported JOIN diseases s ON s.disease_display = t.disease
""", _FEATURES)
_KEY = "week_number year district_id disease_id"
_THRESHOLDS = "lower_threshold upper_threshold outbreak_threshold"
SQL["full_pipeline_tables"] = "\nUNION ALL\n".join([
    table_sums("perdistrictpopulation", with_base(_POPULATION), "district_id population"),
    table_sums("rainfall_data", with_analytics("SELECT * FROM rain_store_full", _RAIN_ROWS), " ".join(["district_id", *_LONG, "annual_rainfall"])),
    table_sums("historicaldata", with_base("SELECT * FROM hist", _KEYED), f"{_KEY} case_count"),
    table_sums("risk_levels", with_base("SELECT * FROM risk_rows", _RISK_ROWS), f"{_KEY} {_THRESHOLDS} risk_score", "risk_level"),
    table_sums("reports", _REPORTS, _KEY, unsummed="case_count"),
    table_sums("weekly_risk_levels", SQL["weekly_risk_levels"], f"year week_number incidence_per_100k {_THRESHOLDS}", "disease area_reported risk_level"),
    table_sums("district_thresholds", SQL["district_thresholds"], f"year mean_incidence std_incidence weeks {_THRESHOLDS}", "disease area_reported"),
])
