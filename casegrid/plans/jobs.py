"""Job functions: the operator bundles a user runs.

Each job takes an :class:`Inputs` bundle (raw case rows, raw population, raw
wide rainfall and the dimensions), so the same jobs run on the surveillance
CSV files (:func:`surveillance_inputs`) or on any other source projected into
that model. Jobs write through Spark's committed writers and keyed tables go
through the staged upsert; nothing is collected to the driver except counts.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.dims import DISEASES, Dims, surveillance_dims
from casegrid.operators import cleaning, correlation, forecast, frame, loads, patterns, rainfall, risk, upsert
from casegrid.session import materialize
from casegrid.sources import files, sinks
from casegrid.sources.checks import pick_existing_column


@dataclass
class Inputs:
    cases: DataFrame          # year, disease, week_number, area_reported, cases_reported [, _row_seq]
    population: DataFrame     # Region, Population
    rainfall: DataFrame       # District, Jan..Dec [, Annual]
    dims: Dims
    years: tuple[int, ...] | None = None  # the loaded years, when known (explicit pivot values)
    missing_files: tuple[str, ...] = ()  # expected case files that are not there


def surveillance_inputs(
    spark: SparkSession,
    datasets_dir: str,
    years: tuple[int, ...] | None = None,
    diseases: tuple[str, ...] | None = None,
    population_file: str = "*population*.csv",
    rainfall_file: str = "*rainfall*.csv",
    missing: str = "skip",
) -> Inputs:
    """Inputs from the surveillance CSV layout: one ``{year}_{Disease}.csv`` per
    year and disease, plus a population and a wide rainfall file (file names
    or glob patterns relative to ``datasets_dir``). Without ``years``, every
    year that the folder has a case file of. ``missing`` is the policy of
    ``files.resolve_paths`` for a (year, disease) without a file."""
    diseases = diseases or tuple(d for _, d in DISEASES.values())
    base = datasets_dir.rstrip("/")
    years = tuple(years) if years else files.case_years(spark, base, diseases)
    paths = files.case_file_paths(base, years, diseases)
    absent = {p for p in paths if not files.path_exists(spark, p)}
    cases = files.read_case_files(spark, paths, missing=missing)
    # years with at least one case file (the pivot columns of the annual table)
    present = tuple(y for y in years if not absent.issuperset(files.case_file_paths(base, [y], diseases)))
    return Inputs(
        cases=cases,
        population=files.read_population(spark, f"{base}/{population_file}"),
        rainfall=files.read_rainfall_wide(spark, f"{base}/{rainfall_file}"),
        dims=surveillance_dims(spark),
        years=present,
        missing_files=tuple(sorted(absent)),
    )


# ---------------------------------------------------------------- risk


def _check_case_files(inputs: Inputs, year: int | None, missing: str) -> None:
    """Apply a missing-file policy to the case files of ``year`` (of all years without it) (S3)."""
    absent = [p for p in inputs.missing_files if year is None or f"/{year}_" in p]
    if absent and missing == "error":
        raise FileNotFoundError(f"Missing case files: {absent}")
    if absent and missing == "skip":
        warnings.warn(f"Skipping missing files: {absent}", stacklevel=3)


def risk_job(inputs: Inputs, out_dir: str | None = None, year: int | None = None,
             missing: str = "error") -> dict[str, DataFrame]:
    """Thresholds and weekly bands; optionally restricted to one year and written as CSV.

    A missing case file of the year is an error, as baselines of half the data would mislead
    (``missing`` = ``skip`` warns, ``silent`` goes on). The joined weekly rows are written
    once (``materialize``); every output reads them.
    """
    _check_case_files(inputs, year, missing)
    cases = cleaning.clean_cases(inputs.cases, inputs.dims, "zero")
    if year is not None:
        cases = cases.filter(F.col("year") == year)
    population = cleaning.clean_population(inputs.population, inputs.dims, keep_invalid=True)
    base = materialize(risk.risk_base(cases, population), "risk-base")
    thresholds = risk.district_thresholds(base)
    weekly = risk.weekly_risk(base, thresholds)
    out = {
        "thresholds": thresholds,
        "weekly_risk": weekly,
        "unmatched_areas": risk.unmatched_areas(cases, population),
        "invalid_population": cleaning.null_rows(population, "population"),
        "risk_rows": risk.risk_storage_rows(weekly, inputs.dims),
        "risk_skips": risk.skip_report(weekly, inputs.dims),
    }
    if out_dir:
        suffix = f"_{year}" if year is not None else ""
        sinks.write_table(thresholds, sinks.table_path(out_dir, f"district_thresholds{suffix}"),
                          order_by=["year", "disease", "area_reported"])
        sinks.write_table(weekly, sinks.table_path(out_dir, f"weekly_risk_levels{suffix}"),
                          order_by=["year", "disease", "week_number", "area_reported"])
    return out


# ---------------------------------------------------------------- analytics


def analytics_frame(inputs: Inputs) -> DataFrame:
    """C2 from the inputs (analytics policy: blank counts dropped, raw rainfall names)."""
    return frame.analytics_frame(
        cleaning.clean_cases(inputs.cases, inputs.dims, "drop"),
        cleaning.clean_population(inputs.population, inputs.dims, dedup=True),
        frame.rainfall_long_raw(inputs.rainfall),
        inputs.dims,
    )


#: Row order of the written analytics tables (O1, O2); ties by name.
ANALYTICS_ORDER: dict[str, list[tuple[str, bool]]] = {
    "disease_hotspots": [("disease", True), ("year", True), ("total_cases", False), ("district", True)],
    "disease_seasonality": [("disease", True), ("year", True), ("week_number", True)],
    "disease_monthly": [("disease", True), ("month", True)],
    "disease_yoy": [("disease", True), ("year", True)],
    "rainfall_monthly_by_district": [("district", True), ("month", True)],
    "rainfall_district_totals": [("rank", True)],
    "rainfall_peak_months": [("district", True)],
    "rainfall_heatmap": [("district", True)],
    "rain_disease_correlation": [("disease", True), ("correlation", False), ("district", True)],
    "rain_disease_lagged_correlation": [("disease", True), ("district", True), ("lag_months", True)],
    "correlation_distribution": [("disease", True)],
    "lagged_correlation_summary": [("disease", True), ("lag_months", True)],
    "summary_annual_cases": [("disease", True)],
    "summary_top_hotspots": [("disease", True), ("total_cases", False), ("district", True)],
    "summary_rainfall_extremes": [("label", False), ("rank", True)],
    "summary_correlation": [("disease", True)],
    "summary_lagged_correlation": [("disease", True)],
}


def analytics_order(name: str) -> list[Column]:
    """Sort columns of an analytics table."""
    return [F.asc(c) if ascending else F.desc(c) for c, ascending in ANALYTICS_ORDER[name]]


def analytics_job(spark: SparkSession, inputs: Inputs, out_dir: str | None = None) -> dict[str, DataFrame]:
    """All analytics tables from one reliable checkpoint of the long frame (C17).

    The long frame feeds every table below, so it is computed once and written
    to the cluster's checkpoint folder (``materialize``); every table then reads
    those files, and a lost executor re-reads files instead of recomputing the
    scans and lookups.
    """
    df = materialize(analytics_frame(inputs), "analytics-frame")
    hot = patterns.hotspots(df)
    yoy = patterns.yoy_change(df)
    monthly_rain = rainfall.monthly_by_district(frame.rainfall_long_raw(inputs.rainfall))
    totals = rainfall.district_totals_ranked(monthly_rain)
    per_district = correlation.per_district(df)
    lagged = correlation.lagged(df)
    tables = {
        # C13 disease patterns
        "disease_hotspots": hot,
        "disease_seasonality": patterns.seasonality(df),
        "disease_monthly": patterns.monthly_profile(df),
        "disease_yoy": yoy,
        # C14 rainfall patterns
        "rainfall_monthly_by_district": monthly_rain,
        "rainfall_district_totals": totals,
        "rainfall_peak_months": rainfall.peak_months(monthly_rain),
        "rainfall_heatmap": rainfall.heatmap(monthly_rain),
        # C15 correlations
        "rain_disease_correlation": per_district,
        "rain_disease_lagged_correlation": lagged,
        "correlation_distribution": correlation.distribution(per_district),
        "lagged_correlation_summary": correlation.lag_summary(lagged),
        # C16 summary tables
        "summary_annual_cases": patterns.annual_pivot(yoy, inputs.years),
        "summary_top_hotspots": patterns.top_hotspots(hot, n=5),
        "summary_rainfall_extremes": rainfall.extremes(totals, n=5),
        "summary_correlation": correlation.summary(per_district),
        "summary_lagged_correlation": correlation.lag_pivot(lagged),
    }
    if out_dir:
        for name, table in tables.items():
            sinks.write_table(table, sinks.table_path(out_dir, name), order_by=analytics_order(name))
    tables["frame"] = df
    return tables


# ---------------------------------------------------------------- forecast


def train_job(inputs: Inputs, model_dir: str | None = None, num_trees: int = 300,
              max_depth: int | None = None, test_size: float = 0.2, seed: int = 42,
              split: str = "random") -> dict:
    """Fit and evaluate the forest; save it when ``model_dir`` is given (M4)."""
    annual, national = rainfall.features(inputs.rainfall, inputs.dims)
    data = forecast.training_frame(
        cleaning.clean_cases(inputs.cases, inputs.dims, "drop"), annual, national, inputs.dims
    )
    data = materialize(data, "training-rows")  # fit, evaluation and the row count read it
    model, metrics = forecast.train(data, num_trees, max_depth, test_size, seed, checkpoint=False, split=split)
    if model_dir:
        forecast.save_model(model, model_dir)
    m = metrics.first()
    return {"model": model, "model_dir": model_dir, "rows": data.count(),
            "mae": float(m["mae"]), "rmse": float(m["rmse"])}


def predict_job(spark: SparkSession, inputs: Inputs, model, year: int = 2026,
                out_dir: str | None = None) -> DataFrame:
    """Score every district x disease x week of ``year`` (M5); optionally write CSV."""
    if isinstance(model, str):
        model = forecast.load_model(model)
    annual, national = rainfall.features(inputs.rainfall, inputs.dims)
    areas, diseases = forecast.labels(model)
    grid = forecast.prediction_grid(spark, areas, diseases, year, annual, national, inputs.dims)
    predictions = forecast.predict(model, grid)
    if out_dir:
        sinks.write_table(predictions, sinks.predictions_path(out_dir, year))
    return predictions


# ---------------------------------------------------------------- keyed loads


def load_historical(spark: SparkSession, inputs: Inputs, table: str) -> dict:
    """Upsert weekly counts into ``historicaldata`` (C8); last row of a key wins.

    The keyed rows are written once; the report, the touched years and the merge read them.
    """
    rows = materialize(loads.keyed_case_rows(inputs.cases, inputs.dims), "historical-rows")
    report = loads.load_counts(rows)
    batch = loads.accepted(rows).drop("disease")
    seq = "_row_seq" if "_row_seq" in batch.columns else None
    counts = upsert.upsert_table(spark, table, batch, loads.HISTORICAL_KEYS, ["case_count"],
                                 id_col="data_id", seq_col=seq, partition_cols=["year"])
    return {"upsert": counts, "report": report}


def load_population(spark: SparkSession, inputs: Inputs, table: str) -> dict:
    """Upsert ``perdistrictpopulation`` (C9); the key is whichever district column a stored table has."""
    key = "district_id"
    if upsert.table_exists(spark, table):
        key = pick_existing_column(upsert.read_table(spark, table), ["districts_id", "district_id"])
        if key is None:
            raise ValueError("the population table has neither a districts_id nor a district_id column")
    batch = loads.population_rows(inputs.population, inputs.dims).withColumnRenamed("district_id", key)
    report = loads.population_report(inputs.population, inputs.dims).first().asDict()
    seq = "_row_seq" if "_row_seq" in batch.columns else None
    return {"upsert": upsert.upsert_table(spark, table, batch, [key], ["population"], id_col="id", seq_col=seq),
            "report": report}


def load_rainfall(spark: SparkSession, inputs: Inputs, table: str) -> dict:
    """Upsert ``rainfall_data`` with backfill, and list districts still missing."""
    rows = rainfall.storage_rows(inputs.rainfall, inputs.dims)
    skipped = cleaning.lookup_district(inputs.rainfall.select("District"), "District", inputs.dims,
                                       district_id="district_id").filter(F.col("district_id").isNull()).count()
    value_cols = [c for c in rows.columns if c != "district_id"]
    counts = upsert.upsert_table(spark, table, rows, ["district_id"], value_cols)
    missing = [r["district"] for r in rainfall.missing_districts(
        upsert.read_table(spark, table), inputs.dims).collect()]
    return {"upsert": counts, "missing_districts": sorted(missing), "skipped_unknown_district": int(skipped)}


def load_risk(spark: SparkSession, risk_out: dict[str, DataFrame], table: str) -> dict:
    """Upsert the ``risk_rows`` of a ``risk_job`` into ``risk_levels`` (C7), and count the rows skipped."""
    counts = upsert.upsert_table(spark, table, risk_out["risk_rows"], loads.RISK_KEYS, list(loads.RISK_SET),
                                 id_col="risk_id", touch_col="calculated_at", partition_cols=["year"])
    return {"upsert": counts, "report": risk_out["risk_skips"].first().asDict()}


def load_predictions(spark: SparkSession, predictions: DataFrame | str, dims: Dims, table: str) -> dict:
    """Upsert predictions, a frame or the path of a CSV, into ``reports`` (C11); last row of a key wins."""
    if isinstance(predictions, str):
        predictions = files.read_predictions(spark, predictions)
    rows = materialize(loads.report_rows(predictions, dims), "report-rows")
    report = loads.load_counts(rows)
    batch = loads.accepted(rows).drop("disease")
    seq = "_row_seq" if "_row_seq" in batch.columns else None
    counts = upsert.upsert_table(spark, table, batch, loads.HISTORICAL_KEYS, ["case_count"], id_col="report_id",
                                 seq_col=seq, partition_cols=["year"])
    return {"upsert": counts, "report": report}


def forecast_job(spark: SparkSession, inputs: Inputs, model_dir: str, out_dir: str, tables_dir: str,
                 year: int = 2026, num_trees: int = 300, max_depth: int | None = None) -> dict:
    """Train, score and store."""
    trained = train_job(inputs, model_dir, num_trees, max_depth)
    predict_job(spark, inputs, trained["model"], year, out_dir)
    # stored from the written table, so the grid is scored once
    stored = load_predictions(spark, sinks.predictions_path(out_dir, year), inputs.dims,
                              sinks.table_path(tables_dir, "reports"))
    return {"train": {k: v for k, v in trained.items() if k != "model"}, "store": stored}


def full_pipeline(spark: SparkSession, inputs: Inputs, tables_dir: str, out_dir: str, model_dir: str,
                  risk_year: int | None = None, prediction_year: int = 2026, num_trees: int = 300,
                  max_depth: int | None = None) -> dict:
    """The seven steps in order (C19): population, rainfall, historical, risk,
    train, predict, store."""
    t = lambda name: sinks.table_path(tables_dir, name)
    result = {
        "population": load_population(spark, inputs, t("perdistrictpopulation")),
        "rainfall": load_rainfall(spark, inputs, t("rainfall_data")),
        "historical": load_historical(spark, inputs, t("historicaldata")),
    }
    risk_out = risk_job(inputs, out_dir, risk_year)
    result["risk"] = load_risk(spark, risk_out, t("risk_levels"))
    result["forecast"] = forecast_job(spark, inputs, model_dir, out_dir, tables_dir, prediction_year,
                                      num_trees, max_depth)
    return result
