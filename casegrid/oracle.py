"""DuckDB reference SQL for the registered queries.

Each query is ``WITH <shared views> <body>``. The shared views re-derive the
surveillance projection of the driver tables (see ``sources/testdata.py``)
independently of the Spark code, in plain SQL. Floating outputs are rounded
half-even at 1e-6 in both engines so the value hashes compare.
"""

from __future__ import annotations

# The projection's fixed values, stated here again so that the SQL doesn't depend on the code it checks.
MONTH_ORDER = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
MISSPELT_NATION = 23
REMAPPED_NATION = 24
TEMPLATE_NATION = 16
BLANK_WEEKS = 13
PER_CUSTOMER = 1000
DISEASE_IDS = {"F": 1, "O": 2, "P": 3}


def canon(expr: str) -> str:
    """Canonical district key in DuckDB SQL (no aliases on the test tables)."""
    stripped = f"regexp_replace(coalesce(CAST({expr} AS VARCHAR), ''), '^\\s+|\\s+$', '', 'g')"
    spaced = f"translate(lower({stripped}), '_-', '  ')"
    collapsed = f"regexp_replace(regexp_replace({spaced}, '\\s+', ' ', 'g'), '^ | $', '', 'g')"
    return f"replace({collapsed}, ' ', '')"


def r6(expr: str) -> str:
    return f"(round_even(({expr}) * 1000000.0, 0) / 1000000.0)"


def r9(expr: str) -> str:
    return f"(round_even(({expr}) * 1000000000.0, 0) / 1000000000.0)"


def week_to_month(expr: str) -> str:
    wk = f"least(greatest({expr}, 1), 53)"
    return f"(CAST(trunc((CAST({wk} - 1 AS DOUBLE) / 53.0) * 12.0) AS INTEGER) + 1)"


def classify(inc: str, lo: str, up: str, ob: str) -> str:
    return (
        f"CASE WHEN {inc} IS NULL OR {lo} IS NULL OR {up} IS NULL OR {ob} IS NULL THEN 'Unknown' "
        f"WHEN {inc} < {lo} THEN 'Below Expected' WHEN {inc} <= {up} THEN 'Normal' "
        f"WHEN {inc} <= {ob} THEN 'Warning' ELSE 'High Risk' END"
    )


_DISEASES_SQL = ", ".join(f"('{k.lower()}', {v}, '{k}')" for k, v in DISEASE_IDS.items())

BASE = f"""
per_order AS (
  SELECT l_orderkey, SUM(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey
),
cells AS (
  SELECT n.n_name AS area, n.n_nationkey AS nationkey, o.o_orderstatus AS disease,
         CAST(year(o.o_orderdate) AS INTEGER) AS year,
         CAST(weekofyear(o.o_orderdate) AS INTEGER) AS week_number,
         SUM(p.qty) AS cases
  FROM per_order p
  JOIN orders o ON p.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  GROUP BY 1, 2, 3, 4, 5
),
raw_cases AS (
  SELECT year,
         CASE WHEN week_number % 2 = 0 THEN lower(disease) ELSE disease END AS disease,
         CAST(week_number AS VARCHAR) AS week_number,
         CASE (week_number + nationkey) % 4
              WHEN 0 THEN area
              WHEN 1 THEN lower(area)
              WHEN 2 THEN ' ' || replace(area, '_', '-') || ' '
              ELSE replace(lower(area), '_', '  ') END AS area_reported,
         CASE WHEN week_number % {BLANK_WEEKS} = 0 THEN ''
              ELSE CAST(CAST(cases AS BIGINT) AS VARCHAR) END AS cases_reported
  FROM cells
),
districts AS (
  SELECT {canon('n_name')} AS district_key, CAST(n_nationkey + 1 AS INTEGER) AS district_id,
         n_name AS district_display
  FROM nation
),
diseases AS (
  SELECT * FROM (VALUES {_DISEASES_SQL}) AS t(disease_key, disease_id, disease_display)
),
parsed_cases AS (
  SELECT r.year, r.disease AS disease_raw, r.area_reported AS area_raw,
         CAST(trunc(TRY_CAST(r.week_number AS DOUBLE)) AS INTEGER) AS week_number,
         TRY_CAST(r.cases_reported AS DOUBLE) AS cases_raw,
         coalesce(d.district_display, r.area_reported) AS district,
         d.district_id,
         coalesce(s.disease_display, r.disease) AS disease,
         s.disease_id
  FROM raw_cases r
  LEFT JOIN districts d ON {canon('r.area_reported')} = d.district_key
  LEFT JOIN diseases s ON lower(trim(r.disease)) = s.disease_key
),
clean_drop AS (
  SELECT year, disease, district, week_number, {week_to_month('week_number')} AS month,
         cases_raw AS cases_reported
  FROM parsed_cases WHERE week_number IS NOT NULL AND cases_raw IS NOT NULL
),
clean_zero AS (
  SELECT year, disease, district, week_number, {week_to_month('week_number')} AS month,
         coalesce(cases_raw, 0.0) AS cases_reported
  FROM parsed_cases WHERE week_number IS NOT NULL
),
raw_population AS (
  SELECT lower(n.n_name) AS Region, format('{{:,}}', c.cnt * {PER_CUSTOMER}) AS Population
  FROM (SELECT c_nationkey, count(*) AS cnt FROM customer GROUP BY 1) c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
population AS (
  SELECT coalesce(d.district_display, p.Region) AS district,
         TRY_CAST(trim(replace(p.Population, ',', '')) AS DOUBLE) AS population,
         d.district_id
  FROM raw_population p LEFT JOIN districts d ON {canon('p.Region')} = d.district_key
),
risk_base AS (
  SELECT c.year, c.disease, c.district AS area_reported, c.week_number, c.cases_reported,
         p.population, c.cases_reported / nullif(p.population, 0) * 100000.0 AS incidence_per_100k
  FROM clean_zero c LEFT JOIN population p ON c.district = p.district
  WHERE p.population IS NOT NULL
),
thresholds AS (
  SELECT year, disease, area_reported,
         avg(incidence_per_100k) AS mean_incidence,
         coalesce(stddev_samp(incidence_per_100k), 0.0) AS std_incidence,
         avg(cases_reported) AS mean_cases,
         coalesce(stddev_samp(cases_reported), 0.0) AS std_cases,
         max(population) AS population,
         CAST(count(DISTINCT week_number) AS INTEGER) AS weeks
  FROM risk_base GROUP BY 1, 2, 3
),
thresholds_full AS (
  SELECT *,
         CASE WHEN mean_incidence - std_incidence IS NOT NULL
              THEN greatest(mean_incidence - std_incidence, 0.0) END AS lower_threshold,
         mean_incidence + std_incidence AS upper_threshold,
         mean_incidence + 2.0 * std_incidence AS outbreak_threshold
  FROM thresholds
),
weekly_risk AS (
  SELECT b.*, t.lower_threshold, t.upper_threshold, t.outbreak_threshold,
         {classify('b.incidence_per_100k', 't.lower_threshold', 't.upper_threshold', 't.outbreak_threshold')} AS risk_level
  FROM risk_base b LEFT JOIN thresholds_full t
    ON b.year = t.year AND b.disease = t.disease AND b.area_reported = t.area_reported
)
"""


def with_base(body: str, extra: str = "") -> str:
    ctes = BASE.strip()
    if extra:
        ctes = ctes + ",\n" + extra.strip()
    return f"WITH {ctes}\n{body.strip()}"


SQL: dict[str, str] = {}

SQL["weekly_risk_levels"] = with_base(f"""
SELECT year, disease, week_number, area_reported, cases_reported, population,
       {r6('incidence_per_100k')} AS incidence_per_100k,
       {r6('lower_threshold')} AS lower_threshold,
       {r6('upper_threshold')} AS upper_threshold,
       {r6('outbreak_threshold')} AS outbreak_threshold,
       risk_level
FROM weekly_risk
""")

SQL["district_thresholds"] = with_base(f"""
SELECT year, disease, area_reported,
       {r6('mean_incidence')} AS mean_incidence, {r6('std_incidence')} AS std_incidence,
       {r6('mean_cases')} AS mean_cases, {r6('std_cases')} AS std_cases,
       population, weeks,
       {r6('lower_threshold')} AS lower_threshold, {r6('upper_threshold')} AS upper_threshold,
       {r6('outbreak_threshold')} AS outbreak_threshold
FROM thresholds_full
""")

SQL["risk_band_counts"] = with_base("""
SELECT year, disease, risk_level, CAST(count(*) AS BIGINT) AS weeks
FROM weekly_risk GROUP BY 1, 2, 3
""")

SQL["unmatched_areas"] = with_base("""
SELECT DISTINCT c.district FROM clean_zero c
WHERE c.district NOT IN (SELECT district FROM population WHERE population IS NOT NULL)
""")

_RISK_ROWS = f"""
risk_ided AS (
  SELECT d.district_id, w.week_number, w.year, s.disease_id, w.risk_level,
         w.lower_threshold, w.upper_threshold, w.outbreak_threshold,
         w.incidence_per_100k AS risk_score,
         CASE w.risk_level WHEN 'Unknown' THEN 0 WHEN 'Below Expected' THEN 1 WHEN 'Normal' THEN 2
              WHEN 'Warning' THEN 3 WHEN 'High Risk' THEN 4 ELSE 0 END AS risk_priority
  FROM weekly_risk w
  LEFT JOIN districts d ON {canon('w.area_reported')} = d.district_key
  LEFT JOIN diseases s ON lower(trim(w.disease)) = s.disease_key
  WHERE d.district_id IS NOT NULL AND s.disease_id IS NOT NULL AND w.week_number IS NOT NULL
    AND w.lower_threshold IS NOT NULL AND w.upper_threshold IS NOT NULL
    AND w.outbreak_threshold IS NOT NULL AND w.incidence_per_100k IS NOT NULL
),
risk_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY district_id, week_number, year, disease_id
                               ORDER BY risk_priority DESC, risk_score DESC) AS rn
  FROM risk_ided
),
risk_rows AS (
  SELECT district_id, week_number, year, disease_id, risk_level,
         CAST(round_even(lower_threshold, 0) AS INTEGER) AS lower_threshold,
         CAST(round_even(upper_threshold, 0) AS INTEGER) AS upper_threshold,
         CAST(round_even(outbreak_threshold, 0) AS INTEGER) AS outbreak_threshold,
         risk_score
  FROM risk_ranked WHERE rn = 1
)
"""

SQL["risk_storage_rows"] = with_base(
    f"""
SELECT district_id, week_number, year, disease_id, risk_level, lower_threshold, upper_threshold,
       outbreak_threshold, {r6('risk_score')} AS risk_score
FROM risk_rows
""",
    _RISK_ROWS,
)


# ---------------------------------------------------------------- analytics

_MONTH_COLS = ", ".join(
    f'CAST(max(CASE WHEN month = {i + 1} THEN mm END) AS VARCHAR) AS "{m}"'
    for i, m in enumerate(MONTH_ORDER)
)
_MONTH_LIST = "[" + ", ".join(f"'{m}'" for m in MONTH_ORDER) + "]"
_UNPIVOT_IN = ", ".join(f'"{m}"' for m in MONTH_ORDER)

ANALYTICS = f"""
rain_cells AS (
  SELECT n.n_name AS area, n.n_nationkey AS nationkey, p.month, SUM(p.cnt) AS mm
  FROM (SELECT l_suppkey, CAST(month(l_shipdate) AS INTEGER) AS month, count(*) AS cnt
        FROM lineitem GROUP BY 1, 2) p
  JOIN supplier s ON p.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  GROUP BY 1, 2, 3
),
rain_wide AS (
  SELECT CASE WHEN nationkey = {MISSPELT_NATION} THEN replace(area, '_', '-') ELSE area END AS District,
         {_MONTH_COLS},
         format('{{:,}}', sum(mm)) AS Annual
  FROM rain_cells WHERE nationkey <> {REMAPPED_NATION}
  GROUP BY 1
),
rain_melt AS (
  SELECT District, month_name, v FROM rain_wide
  UNPIVOT INCLUDE NULLS (v FOR month_name IN ({_UNPIVOT_IN}))
),
rain_long AS (
  SELECT regexp_replace(District, '^\\s+|\\s+$', '', 'g') AS rainfall_area,
         CAST(list_position({_MONTH_LIST}, month_name) AS INTEGER) AS month,
         TRY_CAST(trim(replace(v, ',', '')) AS DOUBLE) AS avg_rainfall_mm
  FROM rain_melt
  WHERE District IS NOT NULL AND TRY_CAST(trim(replace(v, ',', '')) AS DOUBLE) IS NOT NULL
),
pop_dedup AS (
  SELECT district, min(population) AS population FROM population
  WHERE population IS NOT NULL GROUP BY district
),
frame_pre AS (
  SELECT c.year, c.disease, c.district, c.week_number, c.month, c.cases_reported, p.population,
         CASE WHEN {canon('c.district')} = 'nation{REMAPPED_NATION}' THEN 'NATION_{TEMPLATE_NATION}'
              ELSE coalesce(d.district_display, c.district) END AS rainfall_area
  FROM clean_drop c
  LEFT JOIN pop_dedup p ON c.district = p.district
  LEFT JOIN districts d ON {canon('c.district')} = d.district_key
),
frame AS (
  SELECT a.year, a.disease, a.district, a.week_number, a.month, a.cases_reported, a.population,
         a.rainfall_area,
         r0.avg_rainfall_mm AS rainfall_mm,
         r1.avg_rainfall_mm AS rainfall_lag1_mm,
         r2.avg_rainfall_mm AS rainfall_lag2_mm,
         a.cases_reported / nullif(a.population, 0) * 100000.0 AS incidence_per_100k
  FROM frame_pre a
  LEFT JOIN rain_long r0 ON a.rainfall_area = r0.rainfall_area AND a.month = r0.month
  LEFT JOIN rain_long r1 ON a.rainfall_area = r1.rainfall_area AND a.month = (r1.month % 12) + 1
  LEFT JOIN rain_long r2 ON a.rainfall_area = r2.rainfall_area AND a.month = ((r2.month + 1) % 12) + 1
),
hot AS (
  SELECT disease, year, district, sum(cases_reported) AS total_cases, max(population) AS population,
         round_even(sum(cases_reported) / nullif(max(population), 0) * 100000.0 * 100.0, 0) / 100.0
           AS incidence_per_100k
  FROM frame GROUP BY 1, 2, 3
),
annual AS (
  SELECT disease, year, sum(cases_reported) AS total_cases FROM frame GROUP BY 1, 2
),
rain_monthly AS (
  SELECT rainfall_area AS district, month, {_MONTH_LIST}[month] AS month_name, avg_rainfall_mm
  FROM rain_long
),
rain_totals AS (
  SELECT district, sum(avg_rainfall_mm) AS annual_rainfall_mm FROM rain_monthly GROUP BY 1
),
rain_ranked AS (
  SELECT district, annual_rainfall_mm,
         row_number() OVER (ORDER BY annual_rainfall_mm DESC, district ASC) AS rank,
         row_number() OVER (ORDER BY annual_rainfall_mm ASC, district DESC) AS dry_rank
  FROM rain_totals
),
corr_pairs AS (
  SELECT disease, district, 0 AS lag_months, cases_reported AS x, rainfall_mm AS y FROM frame
  UNION ALL
  SELECT disease, district, 1, cases_reported, rainfall_lag1_mm FROM frame
  UNION ALL
  SELECT disease, district, 2, cases_reported, rainfall_lag2_mm FROM frame
),
corr_agg AS (
  SELECT disease, district, lag_months, count(*) AS n,
         min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax,
         covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0) AS r
  FROM corr_pairs WHERE x IS NOT NULL AND y IS NOT NULL
  GROUP BY 1, 2, 3
),
corr_lagged AS (
  SELECT disease, district, lag_months,
         round_even(r * 10000.0, 0) / 10000.0 AS correlation, CAST(n AS INTEGER) AS n_weeks
  FROM corr_agg
  WHERE n >= 10 AND xmin < xmax AND ymin < ymax AND r IS NOT NULL
),
corr_pd AS (
  SELECT disease, district, correlation, n_weeks FROM corr_lagged WHERE lag_months = 0
)
"""


def with_analytics(body: str, extra: str = "") -> str:
    more = ANALYTICS.strip() + ((",\n" + extra.strip()) if extra else "")
    return with_base(body, more)


SQL["clean_cases"] = with_base("SELECT * FROM clean_drop")

SQL["risk_zero_fill"] = with_base("""
SELECT z.year, z.disease, CAST(z.rows AS BIGINT) AS rows, CAST(coalesce(b.blank_rows, 0) AS BIGINT) AS blank_rows,
       z.total_cases
FROM (SELECT year, disease, count(*) AS rows, sum(cases_reported) AS total_cases FROM clean_zero GROUP BY 1, 2) z
LEFT JOIN (SELECT year, disease, count(*) AS blank_rows FROM parsed_cases WHERE cases_raw IS NULL GROUP BY 1, 2) b
  ON z.year = b.year AND z.disease = b.disease
""")

SQL["surveillance_frame"] = with_analytics(f"""
SELECT year, disease, district, week_number, month, cases_reported, population, rainfall_area,
       rainfall_mm, rainfall_lag1_mm, rainfall_lag2_mm, {r6('incidence_per_100k')} AS incidence_per_100k
FROM frame
""")

SQL["hotspots"] = with_analytics("SELECT * FROM hot")

SQL["seasonality"] = with_analytics(f"""
SELECT disease, year, week_number, sum(cases_reported) AS total_cases,
       {r6('avg(cases_reported)')} AS mean_cases_per_district
FROM frame GROUP BY 1, 2, 3
""")

SQL["monthly_profile"] = with_analytics(f"""
SELECT disease, month, sum(cases_reported) AS total_cases, {r6('avg(cases_reported)')} AS mean_cases
FROM frame GROUP BY 1, 2
""")

SQL["yoy_change"] = with_analytics(f"""
SELECT disease, year, total_cases,
       {r6('(total_cases / nullif(lag(total_cases) OVER (PARTITION BY disease ORDER BY year), 0) - 1.0) * 100.0')}
         AS yoy_pct_change
FROM annual
""")

SQL["top_hotspots"] = with_analytics("""
SELECT * FROM (
  SELECT disease, district, total_cases,
         CAST(row_number() OVER (PARTITION BY disease ORDER BY total_cases DESC, district ASC) AS INTEGER) AS rank
  FROM (SELECT disease, district, sum(total_cases) AS total_cases FROM hot GROUP BY 1, 2)
) WHERE rank <= 5
""")

SQL["annual_pivot"] = with_analytics(
    "SELECT d.disease, y.year, CAST(coalesce(a.total_cases, 0) AS BIGINT) AS total_cases "
    "FROM (SELECT DISTINCT disease FROM annual) d CROSS JOIN (SELECT DISTINCT year FROM annual) y "
    "LEFT JOIN annual a ON a.disease = d.disease AND a.year = y.year"
)

SQL["rain_unpivot"] = with_analytics("SELECT * FROM rain_long")
SQL["rain_monthly"] = with_analytics("SELECT * FROM rain_monthly")
SQL["rain_totals_ranked"] = with_analytics(
    "SELECT district, annual_rainfall_mm, CAST(rank AS INTEGER) AS rank FROM rain_ranked"
)
SQL["rain_extremes"] = with_analytics("""
SELECT 'wettest' AS label, district, annual_rainfall_mm, CAST(rank AS INTEGER) AS rank FROM rain_ranked WHERE rank <= 5
UNION ALL
SELECT 'driest', district, annual_rainfall_mm, CAST(rank AS INTEGER) FROM rain_ranked WHERE dry_rank <= 5
""")
SQL["rain_peak_month"] = with_analytics("""
SELECT district, month_name AS peak_month, peak_rainfall_mm FROM (
  SELECT district, month_name, max(avg_rainfall_mm) OVER (PARTITION BY district) AS peak_rainfall_mm,
         row_number() OVER (PARTITION BY district ORDER BY avg_rainfall_mm DESC, month ASC) AS rn
  FROM rain_monthly
) WHERE rn = 1
""")
SQL["rain_heatmap"] = with_analytics(
    "SELECT district, "
    + ", ".join(f"max(CASE WHEN month_name = '{m}' THEN avg_rainfall_mm END) AS \"{m}\"" for m in MONTH_ORDER)
    + " FROM rain_monthly GROUP BY district"
)

_AREA_KEY = (
    f"CASE WHEN {canon('w.District')} = 'nation{REMAPPED_NATION}' THEN 'NATION_{TEMPLATE_NATION}' "
    f"ELSE coalesce(d.district_display, w.District) END"
)
SQL["rain_features_annual"] = with_analytics(f"""
SELECT area_key, min(annual) AS avg_annual_rainfall_mm FROM (
  SELECT {_AREA_KEY} AS area_key, TRY_CAST(trim(replace(w.Annual, ',', '')) AS DOUBLE) AS annual
  FROM rain_wide w LEFT JOIN districts d ON {canon('w.District')} = d.district_key
) WHERE annual IS NOT NULL GROUP BY area_key
""")
SQL["rain_features_national"] = with_analytics(f"""
SELECT CAST(list_position({_MONTH_LIST}, month_name) AS INTEGER) AS month,
       {r6("avg(TRY_CAST(trim(replace(v, ',', '')) AS DOUBLE))")} AS national_avg_rainfall_mm
FROM rain_melt GROUP BY 1
""")

_STRICT = "CAST(round_even(CAST(trim(replace({c}, ',', '')) AS DOUBLE), 0) AS INTEGER)"
_LONG = ["january", "february", "march", "april", "may", "june", "july", "august",
         "september", "october", "november", "december"]
_RAIN_ROWS = f"""
rain_store AS (
  SELECT d.district_id,
         {", ".join(_STRICT.format(c=f'w."{m}"') + f" AS {lname}" for m, lname in zip(MONTH_ORDER, _LONG))},
         {_STRICT.format(c='w.Annual')} AS annual_rainfall
  FROM rain_wide w JOIN districts d ON {canon('w.District')} = d.district_key
),
rain_store_full AS (
  SELECT * FROM rain_store
  UNION ALL
  SELECT {REMAPPED_NATION + 1} AS district_id, {", ".join(_LONG)}, annual_rainfall
  FROM rain_store
  WHERE district_id = {TEMPLATE_NATION + 1}
    AND NOT EXISTS (SELECT 1 FROM rain_store WHERE district_id = {REMAPPED_NATION + 1})
)
"""
SQL["rain_backfill"] = with_analytics("SELECT * FROM rain_store_full", _RAIN_ROWS)
SQL["rain_missing_areas"] = with_analytics(
    "SELECT district_id, district_display AS district FROM districts "
    "WHERE district_id NOT IN (SELECT district_id FROM rain_store_full)",
    _RAIN_ROWS,
)

SQL["rain_case_corr"] = with_analytics("SELECT * FROM corr_pd")
SQL["rain_case_corr_lagged"] = with_analytics("SELECT * FROM corr_lagged")
SQL["corr_summary"] = with_analytics(f"""
SELECT disease, {r9('avg(correlation)')} AS mean_r, {r9('median(correlation)')} AS median_r,
       count(*) AS n_districts
FROM corr_pd GROUP BY disease
""")
SQL["lag_summary"] = with_analytics(f"""
SELECT disease, lag_months, {r9('avg(correlation)')} AS mean_corr, {r9('stddev_samp(correlation)')} AS std_corr,
       round_even(avg(correlation) * 1000.0, 0) / 1000.0 AS mean_corr_3dp
FROM corr_lagged GROUP BY 1, 2
""")
SQL["lag_pivot"] = with_analytics(
    "SELECT disease, "
    + ", ".join(
        f"round_even(avg(CASE WHEN lag_months = {k} THEN correlation END) * 1000.0, 0) / 1000.0 AS lag_{k}mo"
        for k in (0, 1, 2)
    )
    + " FROM corr_lagged GROUP BY disease"
)
SQL["corr_distribution"] = with_analytics(f"""
SELECT disease, {r9('avg(correlation)')} AS mean_r,
       {r9('quantile_cont(correlation, 0.0)')} AS min_r,
       {r9('quantile_cont(correlation, 0.25)')} AS q1_r,
       {r9('quantile_cont(correlation, 0.5)')} AS median_r,
       {r9('quantile_cont(correlation, 0.75)')} AS q3_r,
       {r9('quantile_cont(correlation, 1.0)')} AS max_r
FROM corr_pd GROUP BY disease
""")


# ---------------------------------------------------------------- names, numbers, calendar

SQL["canonical_names"] = with_base(f"""
SELECT r.area_reported, k.district_key, d.district_id,
       coalesce(d.district_display, r.area_reported) AS display_name,
       CASE WHEN k.district_key = 'nation{REMAPPED_NATION}' THEN 'NATION_{TEMPLATE_NATION}'
            ELSE coalesce(d.district_display, r.area_reported) END AS rainfall_area
FROM (SELECT DISTINCT area_reported FROM raw_cases) r
CROSS JOIN LATERAL (SELECT {canon('r.area_reported')} AS district_key) k
LEFT JOIN districts d ON k.district_key = d.district_key
""")

SQL["disease_names"] = with_base("""
SELECT r.disease, lower(trim(r.disease)) AS disease_key, s.disease_id,
       coalesce(s.disease_display, r.disease) AS display_name
FROM (SELECT DISTINCT disease FROM raw_cases) r
LEFT JOIN diseases s ON lower(trim(r.disease)) = s.disease_key
""")

SQL["parse_numbers"] = with_base("""
SELECT Region, Population,
       TRY_CAST(trim(replace(Population, ',', '')) AS DOUBLE) AS population_number,
       CAST(round_even(CAST(trim(replace(Population, ',', '')) AS DOUBLE), 0) AS INTEGER) AS population_int,
       TRY_CAST(Region AS DOUBLE) AS region_as_number
FROM raw_population
""")

_M = week_to_month("week_number")
SQL["week_month_buckets"] = with_base(f"""
SELECT week_number, {_M} AS month, {_MONTH_LIST}[{_M}] AS month_name,
       ({_M} % 12) + 1 AS month_lag1, (({_M} + 1) % 12) + 1 AS month_lag2
FROM (SELECT DISTINCT week_number FROM clean_drop)
""")

SQL["province_lookup"] = with_analytics("""
SELECT t.disease, p.province, sum(t.total_cases) AS total_cases, count(*) AS districts,
       min(p.sort_order) AS first_sort_order
FROM (SELECT disease, district, sum(total_cases) AS total_cases FROM hot GROUP BY 1, 2) t
LEFT JOIN (SELECT n.n_name AS district, r.r_name AS province,
                  CAST(r.r_regionkey * 100 + n.n_nationkey AS INTEGER) AS sort_order
           FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) p
  ON t.district = p.district
GROUP BY 1, 2
""")

# ---------------------------------------------------------------- keyed tables

_KEYED = """
keyed AS (
  SELECT week_number, year, district_id, disease_id, disease,
         CAST(round_even(cases_raw, 0) AS INTEGER) AS case_count
  FROM parsed_cases
  WHERE year IS NOT NULL AND week_number IS NOT NULL AND cases_raw IS NOT NULL
),
hist AS (
  SELECT * FROM keyed WHERE district_id IS NOT NULL AND disease_id IS NOT NULL
)
"""

SQL["historical_rows"] = with_base("SELECT * FROM hist", _KEYED)

SQL["load_report"] = with_base("""
SELECT disease, count(*) AS rows,
       count(*) FILTER (WHERE district_id IS NOT NULL AND disease_id IS NOT NULL) AS accepted,
       count(*) FILTER (WHERE district_id IS NULL) AS skipped_unknown_district,
       count(*) FILTER (WHERE disease_id IS NULL) AS skipped_unknown_disease
FROM keyed GROUP BY disease
""", _KEYED)

SQL["duplicate_keys"] = with_base("""
SELECT week_number, year, district_id, count(*) AS n FROM hist GROUP BY 1, 2, 3 HAVING count(*) > 1
""", _KEYED)

SQL["upsert_cases"] = with_base("""
SELECT coalesce(t.week_number, b.week_number) AS week_number, coalesce(t.year, b.year) AS year,
       coalesce(t.district_id, b.district_id) AS district_id, coalesce(t.disease_id, b.disease_id) AS disease_id,
       CASE WHEN b.year IS NOT NULL THEN b.case_count ELSE t.case_count END AS case_count,
       true AS has_id,
       CASE WHEN b.year IS NOT NULL AND t.year IS NOT NULL THEN 'update'
            WHEN b.year IS NOT NULL THEN 'insert' ELSE 'keep' END AS _merge_action
FROM (SELECT * FROM hist WHERE year <= 1998) t
FULL OUTER JOIN (
  SELECT week_number, year, district_id, disease_id, arg_max(case_count, seq) AS case_count
  FROM (SELECT week_number, year, district_id, disease_id, case_count + 1 AS case_count, 1 AS seq
        FROM hist WHERE year >= 1998
        UNION ALL
        SELECT week_number, year, district_id, disease_id, case_count, 0 AS seq FROM hist WHERE year = 1999)
  GROUP BY 1, 2, 3, 4
) b ON t.week_number = b.week_number AND t.year = b.year AND t.district_id = b.district_id
   AND t.disease_id = b.disease_id
""", _KEYED)

_OLDER_POP = f"""
older_raw AS (
  SELECT lower(n.n_name) AS Region, format('{{:,}}', c.cnt * {PER_CUSTOMER}) AS Population
  FROM (SELECT c_nationkey, count(*) AS cnt FROM customer WHERE c_acctbal > 0 GROUP BY 1) c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)
"""

SQL["upsert_population"] = with_base(
    f"""
SELECT coalesce(t.district_id, b.district_id) AS district_id,
       CASE WHEN b.district_id IS NOT NULL THEN b.population ELSE t.population END AS population,
       true AS has_id,
       CASE WHEN b.district_id IS NOT NULL AND t.district_id IS NOT NULL THEN 'update'
            WHEN b.district_id IS NOT NULL THEN 'insert' ELSE 'keep' END AS _merge_action
FROM (SELECT d.district_id,
             CAST(round_even(TRY_CAST(trim(replace(o.Population, ',', '')) AS DOUBLE), 0) AS INTEGER) AS population
      FROM older_raw o JOIN districts d ON {canon('o.Region')} = d.district_key
      WHERE TRY_CAST(trim(replace(o.Population, ',', '')) AS DOUBLE) IS NOT NULL) t
FULL OUTER JOIN (
      SELECT district_id, CAST(round_even(population, 0) AS INTEGER) AS population
      FROM population WHERE district_id IS NOT NULL AND population IS NOT NULL) b
  ON t.district_id = b.district_id
""",
    _OLDER_POP,
)

_OLD_RAIN = f"""
old_rain_cells AS (
  SELECT n.n_name AS area, n.n_nationkey AS nationkey, p.month, SUM(p.cnt) AS mm
  FROM (SELECT l_suppkey, CAST(month(l_shipdate) AS INTEGER) AS month, count(*) AS cnt
        FROM lineitem WHERE year(l_shipdate) < 1998 GROUP BY 1, 2) p
  JOIN supplier s ON p.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  GROUP BY 1, 2, 3
),
old_rain_wide AS (
  SELECT CASE WHEN nationkey = {MISSPELT_NATION} THEN replace(area, '_', '-') ELSE area END AS District,
         {_MONTH_COLS},
         format('{{:,}}', sum(mm)) AS Annual
  FROM old_rain_cells WHERE nationkey <> {REMAPPED_NATION}
  GROUP BY 1
),
old_store AS (
  SELECT d.district_id,
         {", ".join(_STRICT.format(c=f'w."{m}"') + f" AS {lname}" for m, lname in zip(MONTH_ORDER, _LONG))},
         {_STRICT.format(c='w.Annual')} AS annual_rainfall
  FROM old_rain_wide w JOIN districts d ON {canon('w.District')} = d.district_key
),
old_store_full AS (
  SELECT * FROM old_store
  UNION ALL
  SELECT {REMAPPED_NATION + 1} AS district_id, {", ".join(_LONG)}, annual_rainfall
  FROM old_store
  WHERE district_id = {TEMPLATE_NATION + 1}
    AND NOT EXISTS (SELECT 1 FROM old_store WHERE district_id = {REMAPPED_NATION + 1})
)
"""

SQL["upsert_rainfall"] = with_analytics(
    "SELECT coalesce(t.district_id, b.district_id) AS district_id, "
    + ", ".join(f"CASE WHEN b.district_id IS NOT NULL THEN b.{c} ELSE t.{c} END AS {c}" for c in _LONG + ["annual_rainfall"])
    + """,
       CASE WHEN b.district_id IS NOT NULL AND t.district_id IS NOT NULL THEN 'update'
            WHEN b.district_id IS NOT NULL THEN 'insert' ELSE 'keep' END AS _merge_action
FROM old_store_full t FULL OUTER JOIN rain_store_full b ON t.district_id = b.district_id
""",
    _RAIN_ROWS.strip() + ",\n" + _OLD_RAIN.strip(),
)

SQL["upsert_risk"] = with_base(
    body=f"""
SELECT coalesce(t.district_id, b.district_id) AS district_id, coalesce(t.week_number, b.week_number) AS week_number,
       coalesce(t.year, b.year) AS year, coalesce(t.disease_id, b.disease_id) AS disease_id,
       CASE WHEN b.year IS NOT NULL THEN b.risk_level ELSE t.risk_level END AS risk_level,
       CASE WHEN b.year IS NOT NULL THEN b.lower_threshold ELSE t.lower_threshold END AS lower_threshold,
       CASE WHEN b.year IS NOT NULL THEN b.upper_threshold ELSE t.upper_threshold END AS upper_threshold,
       CASE WHEN b.year IS NOT NULL THEN b.outbreak_threshold ELSE t.outbreak_threshold END AS outbreak_threshold,
       {r6('CASE WHEN b.year IS NOT NULL THEN b.risk_score ELSE t.risk_score END')} AS risk_score,
       true AS has_id, true AS has_time,
       CASE WHEN b.year IS NOT NULL AND t.year IS NOT NULL THEN 'update'
            WHEN b.year IS NOT NULL THEN 'insert' ELSE 'keep' END AS _merge_action
FROM (SELECT * FROM risk_rows WHERE year <= 1998) t
FULL OUTER JOIN (SELECT * FROM risk_rows WHERE year >= 1998) b
  ON t.district_id = b.district_id AND t.week_number = b.week_number AND t.year = b.year
 AND t.disease_id = b.disease_id
""",
    extra=_RISK_ROWS,
)


# ---------------------------------------------------------------- forecast

_FEATURES = f"""
rain_feat_long AS (
  SELECT CASE WHEN {canon('m.District')} = 'nation{REMAPPED_NATION}' THEN 'NATION_{TEMPLATE_NATION}'
              ELSE coalesce(d.district_display, m.District) END AS area_key,
         CAST(list_position({_MONTH_LIST}, m.month_name) AS INTEGER) AS month,
         TRY_CAST(trim(replace(m.v, ',', '')) AS DOUBLE) AS mm
  FROM rain_melt m LEFT JOIN districts d ON {canon('m.District')} = d.district_key
),
feat_annual AS (
  SELECT area_key, min(annual) AS avg_annual_rainfall_mm FROM (
    SELECT {_AREA_KEY} AS area_key, TRY_CAST(trim(replace(w.Annual, ',', '')) AS DOUBLE) AS annual
    FROM rain_wide w LEFT JOIN districts d ON {canon('w.District')} = d.district_key
  ) WHERE annual IS NOT NULL GROUP BY area_key
),
feat_national AS (
  SELECT month, avg(mm) AS national_avg_rainfall_mm FROM rain_feat_long GROUP BY month
),
train_rows AS (
  SELECT c.year, c.week_number, c.month, a.avg_annual_rainfall_mm, n.national_avg_rainfall_mm,
         c.district AS area_reported, c.disease, c.cases_reported
  FROM clean_drop c
  LEFT JOIN districts d ON {canon('c.district')} = d.district_key
  LEFT JOIN feat_annual a ON a.area_key =
       CASE WHEN {canon('c.district')} = 'nation{REMAPPED_NATION}' THEN 'NATION_{TEMPLATE_NATION}'
            ELSE coalesce(d.district_display, c.district) END
  LEFT JOIN feat_national n ON c.month = n.month
  WHERE a.avg_annual_rainfall_mm IS NOT NULL AND n.national_avg_rainfall_mm IS NOT NULL
)
"""

SQL["training_frame"] = with_analytics(
    f"""
SELECT year, week_number, month, avg_annual_rainfall_mm, {r6('national_avg_rainfall_mm')} AS national_avg_rainfall_mm,
       area_reported, disease, cases_reported
FROM train_rows
""",
    _FEATURES,
)

SQL["prediction_grid"] = with_analytics(
    f"""
SELECT 2002 AS year, w.week_number, {week_to_month('w.week_number')} AS month,
       fa.avg_annual_rainfall_mm, {r6('fn.national_avg_rainfall_mm')} AS national_avg_rainfall_mm,
       a.area_reported, s.disease
FROM (SELECT DISTINCT area_reported FROM train_rows) a
CROSS JOIN (SELECT DISTINCT disease FROM train_rows) s
CROSS JOIN (SELECT CAST(range AS INTEGER) AS week_number FROM range(1, 53)) w
LEFT JOIN districts d ON {canon('a.area_reported')} = d.district_key
LEFT JOIN feat_annual fa ON fa.area_key =
     CASE WHEN {canon('a.area_reported')} = 'nation{REMAPPED_NATION}' THEN 'NATION_{TEMPLATE_NATION}'
          ELSE coalesce(d.district_display, a.area_reported) END
LEFT JOIN feat_national fn ON fn.month = {week_to_month('w.week_number')}
""",
    _FEATURES,
)
