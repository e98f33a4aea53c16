"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver tables in full through ``sources.testdata`` and
runs the library operators on them; the matching DuckDB SQL lives in
``casegrid.oracle``. Floating outputs are rounded half-even here only (1e-6;
1e-9 for aggregates of 4-dp correlations), so the engines' last-bit
differences do not break the comparison; the library functions return full
precision.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.functions.calendar import month_name, month_shift, week_to_month
from casegrid.functions.names import disease_key
from casegrid.functions.numbers import lenient_double, parse_thousands, round_half_even, strict_int
from casegrid.operators import cleaning, correlation, forecast, frame, loads, patterns, rainfall, risk, upsert
from casegrid.sources import testdata as td

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


_PLANS: dict[tuple, object] = {}


def shared(fn):
    """Build a shared intermediate plan once per (session, folder, args).

    Only the lazy DataFrame (a logical plan) is reused, which saves driver-side
    analysis; every query still executes its whole plan from the base tables.
    """

    @functools.wraps(fn)
    def wrapper(spark: SparkSession, sf_dir: str, *args):
        key = (fn.__name__, id(spark), sf_dir.rstrip("/"), args)
        if key not in _PLANS:
            _PLANS[key] = fn(spark, sf_dir, *args)
        return _PLANS[key]

    return wrapper


def r6(c: str | Column) -> Column:
    return round_half_even(c, 6)


def r9(c: str | Column) -> Column:
    """For means / quantiles of 4-dp correlations, whose exact values have up
    to 8 decimals and would sit on 1e-6 rounding ties."""
    return round_half_even(c, 9)


# ---------------------------------------------------------------- shared inputs


@shared
def clean_cases(spark: SparkSession, sf_dir: str, null_policy: str) -> DataFrame:
    return cleaning.clean_cases(td.raw_cases(spark, sf_dir), td.dims(spark, sf_dir), null_policy)


@shared
def risk_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_population(
        td.raw_population(spark, sf_dir), td.dims(spark, sf_dir), keep_invalid=True
    )


@shared
def risk_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return risk.risk_tables(clean_cases(spark, sf_dir, "zero"), risk_population(spark, sf_dir))


# ---------------------------------------------------------------- risk


@register("weekly_risk_levels")
def weekly_risk_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, weekly = risk_frames(spark, sf_dir)
    return weekly.select(
        "year", "disease", "week_number", "area_reported", "cases_reported", "population",
        r6("incidence_per_100k").alias("incidence_per_100k"),
        r6("lower_threshold").alias("lower_threshold"),
        r6("upper_threshold").alias("upper_threshold"),
        r6("outbreak_threshold").alias("outbreak_threshold"),
        "risk_level",
    )


@register("district_thresholds")
def district_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    thresholds, _ = risk_frames(spark, sf_dir)
    return thresholds.select(
        "year", "disease", "area_reported",
        *[r6(c).alias(c) for c in ("mean_incidence", "std_incidence", "mean_cases", "std_cases")],
        "population", "weeks",
        *[r6(c).alias(c) for c in ("lower_threshold", "upper_threshold", "outbreak_threshold")],
    )


@register("risk_band_counts")
def risk_band_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, weekly = risk_frames(spark, sf_dir)
    return weekly.groupBy("year", "disease", "risk_level").agg(F.count(F.lit(1)).alias("weeks"))


@register("unmatched_areas")
def unmatched_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk.unmatched_areas(clean_cases(spark, sf_dir, "zero"), risk_population(spark, sf_dir))


@register("risk_storage_rows")
def risk_storage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, weekly = risk_frames(spark, sf_dir)
    rows = risk.risk_storage_rows(weekly, td.dims(spark, sf_dir))
    return rows.withColumn("risk_score", r6("risk_score"))


# ---------------------------------------------------------------- analytics frame


@shared
def analytics_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_population(
        td.raw_population(spark, sf_dir), td.dims(spark, sf_dir), dedup=True
    )


@shared
def rain_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame.rainfall_long_raw(td.raw_rainfall_wide(spark, sf_dir))


@shared
def analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame.analytics_frame(
        clean_cases(spark, sf_dir, "drop"),
        analytics_population(spark, sf_dir),
        rain_long(spark, sf_dir),
        td.dims(spark, sf_dir),
    )


@register("clean_cases")
def clean_cases_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_cases(spark, sf_dir, "drop")


@register("risk_zero_fill")
def risk_zero_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank counts as 0 (risk path): per (year, disease) rows, zero-filled rows, total."""
    zero = clean_cases(spark, sf_dir, "zero")
    raw = td.raw_cases(spark, sf_dir)
    blanks = raw.filter(F.col("cases_reported").try_cast("double").isNull())
    out = zero.groupBy("year", "disease").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("cases_reported").alias("total_cases")
    )
    return out.join(
        cleaning.lookup_disease(blanks, "disease", td.dims(spark, sf_dir), display="d")
        .groupBy("year", F.col("d").alias("disease")).agg(F.count(F.lit(1)).alias("blank_rows")),
        ["year", "disease"],
        "left",
    ).select("year", "disease", "rows", F.coalesce("blank_rows", F.lit(0)).alias("blank_rows"), "total_cases")


@register("surveillance_frame")
def surveillance_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics(spark, sf_dir).withColumn("incidence_per_100k", r6("incidence_per_100k"))


@register("hotspots")
def hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.hotspots(analytics(spark, sf_dir))


@register("seasonality")
def seasonality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = patterns.seasonality(analytics(spark, sf_dir))
    return out.withColumn("mean_cases_per_district", r6("mean_cases_per_district"))


@register("monthly_profile")
def monthly_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.monthly_profile(analytics(spark, sf_dir)).withColumn("mean_cases", r6("mean_cases"))


@register("yoy_change")
def yoy_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.yoy_change(analytics(spark, sf_dir)).withColumn("yoy_pct_change", r6("yoy_pct_change"))


@register("top_hotspots")
def top_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.top_hotspots(patterns.hotspots(analytics(spark, sf_dir)), n=5)


@register("annual_pivot")
def annual_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The disease x year pivot (R3), its cells as rows: the columns of the wide form depend on the data."""
    return patterns.annual_grid(patterns.yoy_change(analytics(spark, sf_dir)))


# ---------------------------------------------------------------- rainfall


@register("rain_unpivot")
def rain_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rain_long(spark, sf_dir)


@register("rain_monthly")
def rain_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rainfall.monthly_by_district(rain_long(spark, sf_dir))


@register("rain_totals_ranked")
def rain_totals_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rainfall.district_totals_ranked(rainfall.monthly_by_district(rain_long(spark, sf_dir)))


@register("rain_extremes")
def rain_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    monthly = rainfall.monthly_by_district(rain_long(spark, sf_dir))
    return rainfall.extremes(rainfall.district_totals_ranked(monthly), n=5)


@register("rain_peak_month")
def rain_peak_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rainfall.peak_months(rainfall.monthly_by_district(rain_long(spark, sf_dir)))


@register("rain_heatmap")
def rain_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rainfall.heatmap(rainfall.monthly_by_district(rain_long(spark, sf_dir)))


@register("rain_features_annual")
def rain_features_annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    annual, _ = rainfall.features(td.raw_rainfall_wide(spark, sf_dir), td.dims(spark, sf_dir))
    return annual


@register("rain_features_national")
def rain_features_national(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, national = rainfall.features(td.raw_rainfall_wide(spark, sf_dir), td.dims(spark, sf_dir))
    return national.withColumn("national_avg_rainfall_mm", r6("national_avg_rainfall_mm"))


@register("rain_backfill")
def rain_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rainfall.storage_rows(td.raw_rainfall_wide(spark, sf_dir), td.dims(spark, sf_dir))


@register("rain_missing_areas")
def rain_missing_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = td.dims(spark, sf_dir)
    return rainfall.missing_districts(rainfall.storage_rows(td.raw_rainfall_wide(spark, sf_dir), dims), dims)


# ---------------------------------------------------------------- correlation


@register("rain_case_corr")
def rain_case_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correlation.per_district(analytics(spark, sf_dir))


@register("rain_case_corr_lagged")
def rain_case_corr_lagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correlation.lagged(analytics(spark, sf_dir))


@register("corr_summary")
def corr_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = correlation.summary(correlation.per_district(analytics(spark, sf_dir)))
    return out.select("disease", r9("mean_r").alias("mean_r"), r9("median_r").alias("median_r"), "n_districts")


@register("lag_summary")
def lag_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = correlation.lag_summary(correlation.lagged(analytics(spark, sf_dir)))
    return out.select(
        "disease", "lag_months", r9("mean_corr").alias("mean_corr"),
        r9("std_corr").alias("std_corr"), "mean_corr_3dp",
    )


@register("lag_pivot")
def lag_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correlation.lag_pivot(correlation.lagged(analytics(spark, sf_dir)))


@register("corr_distribution")
def corr_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = correlation.distribution(correlation.per_district(analytics(spark, sf_dir)))
    return out.select("disease", *[r9(c).alias(c) for c in out.columns if c != "disease"])


# ---------------------------------------------------------------- names, numbers, calendar


@register("canonical_names")
def canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = td.raw_cases(spark, sf_dir).select("area_reported").distinct()
    return cleaning.lookup_district(
        raw, "area_reported", td.dims(spark, sf_dir),
        display="display_name", district_id="district_id", rainfall_area="rainfall_area", key="district_key",
    )


@register("disease_names")
def disease_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = td.raw_cases(spark, sf_dir).select("disease").distinct()
    out = cleaning.lookup_disease(raw, "disease", td.dims(spark, sf_dir), display="display_name", disease_id="disease_id")
    return out.withColumn("disease_key", disease_key("disease"))


@register("parse_numbers")
def parse_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = td.raw_population(spark, sf_dir)
    return raw.select(
        "Region", "Population",
        parse_thousands("Population").alias("population_number"),
        strict_int("Population").alias("population_int"),
        lenient_double("Region").alias("region_as_number"),
    )


@register("week_month_buckets")
def week_month_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    weeks = clean_cases(spark, sf_dir, "drop").select("week_number").distinct()
    return weeks.select(
        "week_number",
        week_to_month("week_number").alias("month"),
        month_name(week_to_month("week_number")).alias("month_name"),
        month_shift(week_to_month("week_number"), 1).alias("month_lag1"),
        month_shift(week_to_month("week_number"), 2).alias("month_lag2"),
    )


@register("province_lookup")
def province_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = patterns.district_totals(patterns.hotspots(analytics(spark, sf_dir)))
    return (
        cleaning.with_province(totals, td.provinces(spark, sf_dir))
        .groupBy("disease", "province")
        .agg(
            F.sum("total_cases").alias("total_cases"),
            F.count(F.lit(1)).alias("districts"),
            F.min("sort_order").alias("first_sort_order"),
        )
    )


# ---------------------------------------------------------------- keyed tables


@shared
def historical_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loads.accepted(loads.keyed_case_rows(td.raw_cases(spark, sf_dir), td.dims(spark, sf_dir)))


@register("historical_rows")
def historical_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return historical_rows(spark, sf_dir)


@register("load_report")
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loads.load_report(loads.keyed_case_rows(td.raw_cases(spark, sf_dir), td.dims(spark, sf_dir)))


@register("duplicate_keys")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loads.duplicate_keys(historical_rows(spark, sf_dir), ["week_number", "year", "district_id"])


@register("upsert_cases")
def upsert_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: stored weeks up to 1998; batch: 1998+ with revised counts, where
    1999 rows arrive twice (older value first) and the last one must win."""
    hist = historical_rows(spark, sf_dir).drop("disease")
    target = hist.filter(F.col("year") <= 1998).withColumn("data_id", F.expr("uuid()"))
    revised = hist.filter(F.col("year") >= 1998).withColumn("case_count", F.col("case_count") + 1)
    stale = hist.filter(F.col("year") == 1999)
    batch = revised.withColumn("seq", F.lit(1)).unionByName(stale.withColumn("seq", F.lit(0)))
    merged = upsert.merge_upsert(
        target, batch, loads.HISTORICAL_KEYS, ["case_count"], id_col="data_id", seq_col="seq", with_action=True,
    )
    return merged.select(*loads.HISTORICAL_KEYS, "case_count",
                         F.col("data_id").isNotNull().alias("has_id"), upsert.ACTION_COL)


@register("upsert_population")
def upsert_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: an older population (customers with a positive balance only);
    batch: the current one."""
    dims = td.dims(spark, sf_dir)
    current = loads.population_rows(td.raw_population(spark, sf_dir), dims)
    older_raw = td.raw_population(spark, sf_dir, positive_balance_only=True)
    target = loads.population_rows(older_raw, dims).withColumn("id", F.expr("uuid()"))
    merged = upsert.merge_upsert(target, current, ["district_id"], ["population"], id_col="id", with_action=True)
    return merged.select("district_id", "population", F.col("id").isNotNull().alias("has_id"), upsert.ACTION_COL)


@register("upsert_rainfall")
def upsert_rainfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: rainfall rows stored from shipments before 1998 (an older
    climatology, with the backfilled district); batch: the current rows."""
    dims = td.dims(spark, sf_dir)
    current = rainfall.storage_rows(td.raw_rainfall_wide(spark, sf_dir), dims)
    older = rainfall.storage_rows(td.raw_rainfall_wide(spark, sf_dir, 1998), dims)
    value_cols = [c for c in current.columns if c != "district_id"]
    merged = upsert.merge_upsert(older, current, ["district_id"], value_cols, with_action=True)
    return merged.select("district_id", *value_cols, upsert.ACTION_COL)


@register("upsert_risk")
def upsert_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: stored risk rows up to 1998; batch: rows from 1998 on."""
    _, weekly = risk_frames(spark, sf_dir)
    rows = risk.risk_storage_rows(weekly, td.dims(spark, sf_dir))
    target = (
        rows.filter(F.col("year") <= 1998)
        .withColumn("risk_id", F.expr("uuid()"))
        .withColumn("calculated_at", F.current_timestamp())
    )
    batch = rows.filter(F.col("year") >= 1998)
    merged = upsert.merge_upsert(
        target, batch, loads.RISK_KEYS, loads.RISK_SET,
        id_col="risk_id", touch_col="calculated_at", with_action=True,
    )
    return merged.select(
        *loads.RISK_KEYS, *[c for c in loads.RISK_SET if c != "risk_score"],
        r6("risk_score").alias("risk_score"),
        F.col("risk_id").isNotNull().alias("has_id"),
        F.col("calculated_at").isNotNull().alias("has_time"),
        upsert.ACTION_COL,
    )


# ---------------------------------------------------------------- forecast

PREDICTION_YEAR = 2002  # the year after the last order year in the test tables
QUERY_TREES = 20        # small forest for the registered check; library default is 300
QUERY_DEPTH = 10


@shared
def training(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = td.dims(spark, sf_dir)
    annual, national = rainfall.features(td.raw_rainfall_wide(spark, sf_dir), dims)
    return forecast.training_frame(clean_cases(spark, sf_dir, "drop"), annual, national, dims)


@register("training_frame")
def training_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training(spark, sf_dir).withColumn("national_avg_rainfall_mm", r6("national_avg_rainfall_mm"))


@register("prediction_grid")
def prediction_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring grid from the categories an indexer learns on the training frame."""
    from pyspark.ml.feature import StringIndexer

    dims = td.dims(spark, sf_dir)
    annual, national = rainfall.features(td.raw_rainfall_wide(spark, sf_dir), dims)
    train_df = forecast.training_frame(clean_cases(spark, sf_dir, "drop"), annual, national, dims)
    indexer = StringIndexer(inputCols=forecast.CATEGORICAL, outputCols=["a_idx", "d_idx"]).fit(train_df)
    areas, diseases = (sorted(x) for x in indexer.labelsArray)
    grid = forecast.prediction_grid(spark, list(areas), list(diseases), PREDICTION_YEAR, annual, national, dims)
    return grid.withColumn("national_avg_rainfall_mm", r6("national_avg_rainfall_mm"))


@shared
def _fitted(spark: SparkSession, sf_dir: str):
    """Training rows, forest and metrics; the queries of a session and folder use one forest."""
    data = training(spark, sf_dir)
    model, metrics = forecast.train(data, num_trees=QUERY_TREES, max_depth=QUERY_DEPTH)
    return data, model, metrics


@register("forecast_metrics")
def forecast_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hold-out MAE / RMSE of the forest (rows-only check: not SQL-expressible)."""
    _, _, metrics = _fitted(spark, sf_dir)
    return metrics


@register("forecast_predictions")
def forecast_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored grid for the next year (rows-only check)."""
    dims = td.dims(spark, sf_dir)
    annual, national = rainfall.features(td.raw_rainfall_wide(spark, sf_dir), dims)
    _, model, _ = _fitted(spark, sf_dir)
    areas, diseases = forecast.labels(model)
    grid = forecast.prediction_grid(spark, areas, diseases, PREDICTION_YEAR, annual, national, dims)
    return forecast.predict(model, grid)


@register("upsert_reports")
def upsert_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions upserted into a reports table (C11, rows-only check).

    Target: all weekly counts, already stored as reports; batch: the scored
    grids of the last data year (which update) and of the next one (which
    insert), keyed like the reports table (ids looked up, counts rounded
    half-even).
    """
    dims = td.dims(spark, sf_dir)
    annual, national = rainfall.features(td.raw_rainfall_wide(spark, sf_dir), dims)
    _, model, _ = _fitted(spark, sf_dir)
    areas, diseases = forecast.labels(model)
    grid = forecast.prediction_grid(spark, areas, diseases, PREDICTION_YEAR - 1, annual, national, dims).unionByName(
        forecast.prediction_grid(spark, areas, diseases, PREDICTION_YEAR, annual, national, dims))
    batch = loads.accepted(loads.report_rows(forecast.predict(model, grid), dims)).drop("disease")
    target = (
        historical_rows(spark, sf_dir).drop("disease")
        .withColumn("report_id", F.expr("uuid()"))
    )
    merged = upsert.merge_upsert(target, batch, loads.HISTORICAL_KEYS, ["case_count"],
                                 id_col="report_id", with_action=True)
    return merged.select(*loads.HISTORICAL_KEYS, "case_count", upsert.ACTION_COL)
