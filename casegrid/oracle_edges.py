"""DuckDB SQL of the queries on faulty inputs (``casegrid.plans.edge_cases``).

Importing this module adds them to ``oracle.SQL``.
"""

from __future__ import annotations

from casegrid.oracle import (
    _FEATURES,
    _KEYED,
    _LONG,
    _OLD_RAIN,
    _OLDER_POP,
    _RAIN_ROWS,
    SQL,
    canon,
    classify,
    r6,
    week_to_month,
    with_analytics,
    with_base,
)

__all__ = ["SQL"]

_NUMBER = "^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$"

_FAULTY = f"""
faulty AS (
  SELECT year, CASE WHEN w % 10 = 7 THEN 'X' ELSE disease END AS disease, w AS week_number,
         CASE w % 10 WHEN 5 THEN 'Old ' || area_reported
                     WHEN 8 THEN replace(area_reported, '_', chr(160)) ELSE area_reported END AS area,
         CASE w % 10 WHEN 3 THEN cases_reported || 'd' WHEN 4 THEN 'nan' WHEN 6 THEN 'inf'
                     ELSE cases_reported END AS cases_text
  FROM (SELECT *, CAST(week_number AS INTEGER) AS w FROM raw_cases)
),
faulty_parsed AS (
  SELECT f.year, f.week_number, d.district_id, s.disease_id,
         coalesce(d.district_display, f.area) AS district, coalesce(s.disease_display, f.disease) AS disease,
         CASE WHEN regexp_matches(f.cases_text, '{_NUMBER}') THEN CAST(f.cases_text AS DOUBLE) END AS cases
  FROM faulty f
  LEFT JOIN districts d ON {canon("replace(f.area, chr(160), ' ')")} = d.district_key
  LEFT JOIN diseases s ON lower(trim(f.disease)) = s.disease_key
)
"""

SQL["load_report_faulty"] = with_base("""
SELECT disease, count(*) AS rows,
       count(*) FILTER (WHERE district_id IS NOT NULL AND disease_id IS NOT NULL) AS accepted,
       count(*) FILTER (WHERE district_id IS NULL) AS skipped_unknown_district,
       count(*) FILTER (WHERE disease_id IS NULL) AS skipped_unknown_disease
FROM faulty_parsed WHERE cases IS NOT NULL GROUP BY disease
""", _FAULTY)

SQL["clean_cases_faulty"] = with_base(f"""
SELECT year, disease, district, week_number, {week_to_month('week_number')} AS month,
       coalesce(cases, 0.0) AS cases_reported
FROM faulty_parsed
""", _FAULTY)

SQL["unmatched_areas_gaps"] = with_base("""
SELECT DISTINCT district FROM clean_zero
WHERE district IN ('NATION_3', 'NATION_4')
   OR district NOT IN (SELECT district FROM population WHERE population IS NOT NULL)
""")

SQL["invalid_population_rows"] = with_base("""
SELECT district, CAST(NULL AS DOUBLE) AS population FROM population WHERE district = 'NATION_4'
""")

_REPEATED = _OLDER_POP.strip() + f""",
repeated AS (
  SELECT d.district_id, d.district_display AS district, r.seq,
         CAST(replace(r.Population, ',', '') AS DOUBLE) AS population
  FROM (SELECT Region, Population, 1 AS seq FROM older_raw
        UNION ALL SELECT Region, Population, 2 FROM raw_population) r
  JOIN districts d ON {canon('r.Region')} = d.district_key
)
"""

SQL["population_first_row"] = with_base("""
SELECT district, population FROM (
  SELECT *, row_number() OVER (PARTITION BY district ORDER BY seq) AS place FROM repeated
) WHERE place = 1
""", _REPEATED)

SQL["population_last_row"] = with_base("""
SELECT district_id, CAST(round_even(population, 0) AS INTEGER) AS population, true AS has_id,
       'update' AS _merge_action
FROM (SELECT *, row_number() OVER (PARTITION BY district_id ORDER BY seq DESC) AS place FROM repeated)
WHERE place = 1
""", _REPEATED)

_TWICE = f"""
twice AS (
  SELECT year, week_number, area_reported, disease, lower_threshold, upper_threshold, outbreak_threshold,
         incidence_per_100k AS score FROM weekly_risk
  UNION ALL
  SELECT year, week_number, area_reported, disease, lower_threshold, upper_threshold, outbreak_threshold,
         incidence_per_100k * CASE WHEN week_number % 2 = 1 THEN 1.5 ELSE 0.5 END FROM weekly_risk
),
twice_banded AS (
  SELECT t.*, d.district_id, s.disease_id,
         {classify('score', 'lower_threshold', 'upper_threshold', 'outbreak_threshold')} AS risk_level
  FROM twice t
  JOIN districts d ON t.area_reported = d.district_display
  JOIN diseases s ON t.disease = s.disease_display
),
twice_ranked AS (
  SELECT *, row_number() OVER (
           PARTITION BY district_id, week_number, year, disease_id
           ORDER BY list_position(['Below Expected', 'Normal', 'Warning', 'High Risk'], risk_level) DESC, score DESC
         ) AS place
  FROM twice_banded
)
"""

SQL["risk_best_row"] = with_base(f"""
SELECT district_id, week_number, year, disease_id, risk_level,
       CAST(round_even(lower_threshold, 0) AS INTEGER) AS lower_threshold,
       CAST(round_even(upper_threshold, 0) AS INTEGER) AS upper_threshold,
       CAST(round_even(outbreak_threshold, 0) AS INTEGER) AS outbreak_threshold,
       {r6('score')} AS risk_score
FROM twice_ranked WHERE place = 1
""", _TWICE)

SQL["risk_skips"] = with_base("""
SELECT count(*) AS rows,
       count(*) FILTER (WHERE area_reported IN ('NATION_5', 'NATION_6')) AS skipped_unknown_district,
       count(*) FILTER (WHERE disease = 'P') AS skipped_unknown_disease
FROM weekly_risk
""")

_VALUES = ", ".join([*_LONG, "annual_rainfall"])
_GAPPY_RAIN = _RAIN_ROWS.strip() + ",\n" + _OLD_RAIN.strip() + f""",
gappy_store AS (
  SELECT district_id, {_VALUES} FROM rain_store_full WHERE district_id <> 3
    AND (district_id <> 2 OR NOT EXISTS (SELECT 1 FROM old_store WHERE district_id = 2))
  UNION ALL
  SELECT district_id, {_VALUES} FROM old_store WHERE district_id = 2
)
"""

SQL["rain_backfill_gaps"] = with_analytics(f"SELECT district_id, {_VALUES} FROM gappy_store", _GAPPY_RAIN)

SQL["rain_missing_areas_gaps"] = with_analytics("""
SELECT district_id, district_display AS district FROM districts
WHERE district_id NOT IN (SELECT district_id FROM gappy_store)
""", _GAPPY_RAIN)

SQL["rain_case_corr_guards"] = with_analytics(
    "SELECT * FROM corr_pd WHERE district NOT IN ('NATION_7', 'NATION_8')"
)

_SPLIT = _FEATURES.strip() + """,
split AS (
  SELECT *, CAST('0x' || substr(md5(concat_ws('|', '42', year, week_number, area_reported, disease)), 1, 8) AS BIGINT)
            % 10000 < 2000 AS in_test
  FROM train_rows
),
split_means AS (
  SELECT area_reported, disease, avg(cases_reported) AS prediction FROM split WHERE NOT in_test GROUP BY 1, 2
)
"""

SQL["holdout_split"] = with_analytics("SELECT year, week_number, area_reported, disease, in_test FROM split", _SPLIT)

SQL["holdout_error"] = with_analytics(f"""
SELECT count(*) AS test_rows, {r6('avg(abs(prediction - cases_reported))')} AS mae,
       {r6('sqrt(avg((prediction - cases_reported) * (prediction - cases_reported)))')} AS rmse
FROM split JOIN split_means USING (area_reported, disease) WHERE in_test
""", _SPLIT)

SQL["one_hot_columns"] = with_analytics("""
SELECT feature, category, CAST(n - 1 AS INTEGER) AS width,
       CAST(CASE WHEN place = n THEN 0 ELSE place END AS INTEGER) AS position
FROM (
  SELECT *, row_number() OVER (PARTITION BY feature ORDER BY category DESC) AS place,
         count(*) OVER (PARTITION BY feature) AS n
  FROM (SELECT DISTINCT 'area_reported' AS feature, area_reported AS category FROM train_rows
        UNION ALL SELECT DISTINCT 'disease', disease FROM train_rows)
)
""", _FEATURES)

SQL["upsert_reports_fixed"] = with_base("""
SELECT coalesce(t.week_number, b.week_number) AS week_number, coalesce(t.year, b.year) AS year,
       coalesce(t.district_id, b.district_id) AS district_id, coalesce(t.disease_id, b.disease_id) AS disease_id,
       CASE WHEN b.year IS NOT NULL THEN b.predicted ELSE t.case_count END AS case_count, true AS has_id,
       CASE WHEN b.year IS NOT NULL AND t.year IS NOT NULL THEN 'update'
            WHEN b.year IS NOT NULL THEN 'insert' ELSE 'keep' END AS _merge_action
FROM hist t FULL OUTER JOIN fixed b
  ON t.week_number = b.week_number AND t.year = b.year AND t.district_id = b.district_id
 AND t.disease_id = b.disease_id
""", _KEYED.strip() + """,
fixed AS (
  SELECT y.year, c.week_number, d.district_id, s.disease_id,
         CAST(greatest(round_even(c.mean - 40.25, 0), 0.0) AS INTEGER) AS predicted
  FROM (SELECT district, disease, week_number, avg(cases_reported) AS mean FROM clean_drop GROUP BY 1, 2, 3) c
  JOIN districts d ON c.district = d.district_display
  JOIN diseases s ON c.disease = s.disease_display
  CROSS JOIN (VALUES (2001), (2002)) y(year)
)
""")
