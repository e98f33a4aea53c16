"""Registered queries whose rows went through files: sources, sinks and row order.

The projected tables are written in the formats the surveillance files have, under the
session's checkpoint folder, and read back by the library's readers. The last two run whole jobs
over such files and sum up every table that the jobs wrote. Importing this module adds
the queries to ``catalog.QUERIES``; their SQL is in ``casegrid.oracle_files``.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.functions.numbers import round_half_even
from casegrid.operators import cleaning, forecast, forest_table, loads, rainfall, risk, upsert
from casegrid.operators.ordering import with_row_numbers
from casegrid.plans import jobs
from casegrid.plans.catalog import PREDICTION_YEAR, QUERY_DEPTH, QUERY_TREES, _fitted, clean_cases, historical_rows, register, risk_frames
from casegrid.plans.edge_cases import QUERIES
from casegrid.session import ensure_checkpoint_dir
from casegrid.sources import files, sinks
from casegrid.sources import testdata as td
from casegrid.streaming import start_historical_ingest

__all__ = ["QUERIES"]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/casegrid-{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- sources


def written_cases(spark: SparkSession, sf_dir: str) -> list[str]:
    """The raw cases as files: quoted ones, ones with a byte order mark, and ones with another order of columns."""
    raw, folder = td.raw_cases(spark, sf_dir), new_folder(spark, "case-files")
    code = F.upper("disease")
    return [
        *sinks.write_case_files(raw.where(code == "F"), folder, quote_all=True),
        *sinks.write_case_files(raw.where(code == "O"), folder, bom=True),
        *sinks.write_case_files(raw.where(~code.isin("F", "O")), folder, ["cases_reported", "week_number", "area_reported"]),
    ]


@register("case_files")
def case_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case files (S1, U1) with year and disease from their names (S2); a file that isn't there is passed over (S3)."""
    paths = written_cases(spark, sf_dir)
    missing = paths[0].rsplit("/", 1)[0] + "/1890_F.csv"
    rows = files.read_case_files(spark, [*paths, missing], missing="silent")
    blank = F.when(F.col("cases_reported") != "", F.col("cases_reported"))
    return rows.select("year", "disease", "week_number", "area_reported", blank.alias("cases_reported"))


@register("clean_case_files")
def clean_case_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned frame (C1) of rows that came from files."""
    return cleaning.clean_cases(files.read_case_files(spark, written_cases(spark, sf_dir)), td.dims(spark, sf_dir), "zero")


def written_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Population and wide rainfall written as CSV (rainfall with ``Area`` for ``District``) and read back."""
    folder = new_folder(spark, "inputs")
    for name, df in (("population", td.raw_population(spark, sf_dir)), ("rainfall", td.raw_rainfall_wide(spark, sf_dir).withColumnRenamed("District", "Area"))):
        df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/{name}.csv")
    return files.read_population(spark, f"{folder}/population.csv"), files.read_rainfall_wide(spark, f"{folder}/rainfall.csv")


@register("input_files")
def input_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population (S4) and wide rainfall (S5, with ``Area`` for ``District``) from CSV, as cells."""
    population, rain = written_inputs(spark, sf_dir)
    cells = rain.unpivot("District", [c for c in rain.columns if c != "District"], "column", "value")
    return population.select(F.col("Region").alias("area"), F.lit("Population").alias("column"), F.col("Population").alias("value")).unionByName(
        cells.select(F.col("District").alias("area"), "column", "value"))


@register("prediction_files")
def prediction_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions from CSV (S9) as report rows (C11); the predictions are a week's mean count, rounded."""
    means = clean_cases(spark, sf_dir, "drop").groupBy("district", "disease", "week_number").agg(F.avg("cases_reported").alias("mean"))
    predictions = means.select(F.lit(PREDICTION_YEAR).alias("year"), "week_number", F.col("district").alias("area_reported"), "disease",
                               F.rint("mean").cast("int").alias("predicted_cases"))
    path = sinks.write_table(predictions, sinks.predictions_path(new_folder(spark, "predictions"), PREDICTION_YEAR))
    rows = loads.accepted(loads.report_rows(files.read_predictions(spark, path), td.dims(spark, sf_dir)))
    return rows.select(*loads.HISTORICAL_KEYS, "case_count")


# ---------------------------------------------------------------- bad numbers


@register("clean_cases_bad_weeks")
def clean_cases_bad_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks that no int holds, that are text or blank are missing, and a fraction is cut off; nothing ends the job."""
    raw = td.raw_cases(spark, sf_dir)
    digit = F.pmod(F.col("week_number").cast("int"), F.lit(10))
    week = (
        F.when(digit == 1, F.lit("1e12")).when(digit == 2, F.lit("week")).when(digit == 4, F.lit(""))
        .when(digit == 7, F.concat("week_number", F.lit(".7"))).otherwise(F.col("week_number"))
    )
    return cleaning.clean_cases(raw.withColumn("week_number", week), td.dims(spark, sf_dir), "zero")


# ---------------------------------------------------------------- row order

_WEEKLY_ORDER = ["year", "disease", "week_number", "area_reported"]


@register("weekly_risk_order")
def weekly_risk_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly bands written as CSV in their order (S7, O2) and numbered as they stand in the files."""
    _, weekly = risk_frames(spark, sf_dir)
    rows = weekly.select(*_WEEKLY_ORDER, "risk_level")
    path = sinks.write_table(rows, new_folder(spark, "weekly"), order_by=_WEEKLY_ORDER)
    return files.read_in_order(spark, path, "year int, disease string, week_number int, area_reported string, risk_level string")


@register("hotspot_order")
def hotspot_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by district, numbered in a mixed-direction order (O1): largest count first, then by name."""
    totals = clean_cases(spark, sf_dir, "drop").groupBy("disease", "district").agg(F.sum("cases_reported").alias("total_cases"))
    order = [F.asc("disease"), F.desc("total_cases"), F.asc("district")]
    overall = with_row_numbers(totals, order, "row_number")
    return with_row_numbers(overall, order[1:], "rank", ["disease"]).select("disease", "district", "total_cases", "row_number", "rank")


@register("preview_rows")
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count and first five rows (S11, O4) of the stored risk rows in key order."""
    _, weekly = risk_frames(spark, sf_dir)
    rows = risk.risk_storage_rows(weekly, td.dims(spark, sf_dir)).select("year", "disease_id", "week_number", "district_id", "risk_level")
    count, first = files.preview(rows, 5, ["year", "disease_id", "week_number", "district_id"])
    return first.withColumn("rows", F.lit(count).cast("long"))


# ---------------------------------------------------------------- unseen levels


@register("unseen_levels")
def unseen_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of an unknown district, and of an unknown disease, next to those of the baseline level with the same numbers."""
    dims = td.dims(spark, sf_dir)
    annual, national = rainfall.features(td.raw_rainfall_wide(spark, sf_dir), dims)
    _, model, _ = _fitted(spark, sf_dir)
    areas, diseases = forecast.labels(model)
    grid = forecast.prediction_grid(spark, areas, diseases, PREDICTION_YEAR, annual, national, dims)
    known = forecast.predict(model, grid)
    key = ["week_number", "area_reported", "disease"]
    both = []
    for column, baseline, unknown in (("area_reported", areas[0], "Elsewhere"), ("disease", diseases[0], "Q")):
        scored = forecast.predict(model, grid.where(F.col(column) == baseline).withColumn(column, F.lit(unknown)))
        same = known.where(F.col(column) == baseline).select(*[F.col(k).alias(f"b_{k}") for k in key], F.col("predicted_cases").alias("expected"))
        on = [F.col(k) == F.col(f"b_{k}") for k in key if k != column]
        both.append(scored.join(same, on[0] & on[1]).select(*key, (F.col("predicted_cases") == F.col("expected")).alias("as_baseline")))
    return both[0].unionByName(both[1])


@register("forest_table")
def forest_table_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid scored by the saved forest's node table (M3) against the fitted model and the loaded one (S10): equal to the last bit."""
    dims = td.dims(spark, sf_dir)
    annual, national = rainfall.features(td.raw_rainfall_wide(spark, sf_dir), dims)
    _, model, _ = _fitted(spark, sf_dir)
    path = forecast.save_model(model, new_folder(spark, "model"))
    areas, diseases = forecast.labels(model)
    grid = forecast.prediction_grid(spark, areas, diseases, PREDICTION_YEAR, annual, national, dims)
    given = forecast.transform(model, grid).withColumnRenamed("prediction", "fitted")
    loaded = forecast.transform(forecast.load_model(path), given.select(*grid.columns, "fitted")).withColumnRenamed("prediction", "loaded")
    scored = forest_table.score_by_nodes(loaded, forest_table.forest_nodes(spark, path), QUERY_DEPTH)
    return scored.select("week_number", "area_reported", "disease", (F.col("prediction") == F.col("fitted")).alias("as_fitted"),
                         (F.col("prediction") == F.col("loaded")).alias("as_loaded"))


# ---------------------------------------------------------------- keyed tables on disk


def _counts(spark: SparkSession, steps: list[dict]) -> DataFrame:
    """What each write observed, a row for each."""
    return spark.createDataFrame([(i + 1, s["inserted"], s["updated"], s["unchanged"]) for i, s in enumerate(steps)],
                                 "step int, inserted long, updated long, unchanged long")


@register("upsert_cycle")
def upsert_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored, partitioned table (S8): created, revised, the same revision again. Its rows, and what each write counted.

    The revision covers the first half of the years from 1998, so later weeks of 1998 stay and years before it are not read.
    """
    hist = historical_rows(spark, sf_dir).drop("disease")
    revision = hist.where("year >= 1998 AND week_number <= 26").withColumn("case_count", F.col("case_count") + 1)
    path = new_folder(spark, "historical")
    steps = [
        upsert.upsert_table(spark, path, batch, loads.HISTORICAL_KEYS, ["case_count"], id_col="data_id", partition_cols=["year"])
        for batch in (hist.where("year <= 1998"), revision, revision)
    ]
    rows = upsert.read_table(spark, path)
    ids = rows.agg(F.count_distinct("data_id").alias("n"), F.count("*").alias("rows")).first()
    if ids["n"] != ids["rows"]:
        raise ValueError("an id stands twice")
    return rows.select(*loads.HISTORICAL_KEYS, "case_count").unionByName(_counts(spark, steps), allowMissingColumns=True)


@register("population_swap")
def population_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored table without partitions (S8, C9): written beside and swapped in, then again with half of the districts changed."""
    rows = loads.population_rows(td.raw_population(spark, sf_dir), td.dims(spark, sf_dir)).select("district_id", "population")
    changed = rows.where("district_id % 2 = 0").withColumn("population", F.col("population") + 1)
    path = new_folder(spark, "population")
    steps = [upsert.upsert_table(spark, path, batch, ["district_id"], ["population"], id_col="id") for batch in (rows, changed)]
    table = upsert.read_table(spark, path).select("district_id", "population")
    return table.unionByName(_counts(spark, steps), allowMissingColumns=True)


@register("integer_ids")
def integer_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense integer ids (S14): stored rows keep theirs; new rows get the next numbers, in any order, so their keys are left out."""
    hist = historical_rows(spark, sf_dir).drop("disease")
    key = list(loads.HISTORICAL_KEYS)
    target = with_row_numbers(hist.where("year <= 1995"), [F.col(k) for k in key], "data_id")
    merged = upsert.merge_upsert(target, hist, key, ["case_count"], id_col="data_id", with_action=True)
    old = F.col(upsert.ACTION_COL) != "insert"
    return merged.select(*[F.when(old, F.col(k)).alias(k) for k in key], "data_id", F.col(upsert.ACTION_COL).alias("action"))


# ---------------------------------------------------------------- late corrections


@register("late_corrections")
def late_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case files dropped into a folder and ingested by a stream; a restart that finds nothing new; then corrections of
    the first half of each year, dropped later and ingested after one more restart. The stored table, and what each run
    counted. A correction raises a count by one, or brings in a week that was blank."""
    raw, base = td.raw_cases(spark, sf_dir), new_folder(spark, "ingest")
    count = F.col("cases_reported")
    corrected = raw.where(F.col("week_number").cast("int") <= 26).withColumn(
        "cases_reported", F.when(count == "", F.lit("7")).otherwise((count.cast("long") + 1).cast("string")))
    dims, runs = td.dims(spark, sf_dir), []
    for number, drop in enumerate((raw, None, corrected)):
        if drop is not None:
            sinks.write_case_files(drop, f"{base}/drops/{number}")
        done = {"inserted": 0, "updated": 0, "unchanged": 0}
        runs.append(done)

        def add(epoch: int, counts: dict, done: dict = done) -> None:
            done.update({k: done[k] + counts[k] for k in done})

        start_historical_ingest(spark, f"{base}/drops/*/*.csv", f"{base}/table", f"{base}/progress", dims, on_batch=add).awaitTermination()
    rows = upsert.read_table(spark, f"{base}/table").select(*loads.HISTORICAL_KEYS, "case_count")
    return rows.unionByName(_counts(spark, runs), allowMissingColumns=True)


# ---------------------------------------------------------------- whole jobs


def file_inputs(spark: SparkSession, sf_dir: str) -> jobs.Inputs:
    """The inputs of a job, all of them read from files."""
    cases = files.read_case_files(spark, written_cases(spark, sf_dir))
    return jobs.Inputs(cases, *written_inputs(spark, sf_dir), td.dims(spark, sf_dir))


def table_sums(name: str, rows: DataFrame, kinds: list[tuple[str, str]], unsummed: tuple[str, ...] = (), digits: int = 6) -> DataFrame:
    """For each column of a table: its rows, its cells that hold a value, and their sum.

    Numbers are rounded half-even at ``digits`` and added as decimals, texts by the first 32 bits of their MD5, so that
    the sum depends on neither row order nor engine. ``unsummed`` columns only get counts.
    """
    def total(column: str, kind: str) -> F.Column:
        if column in unsummed:
            return F.lit(None).cast("double")
        cell = F.col(f"`{column}`")
        number = F.conv(F.substring(F.md5(cell.cast("binary")), 1, 8), 16, 10) if kind == "string" else round_half_even(cell.cast("double"), digits)
        return F.sum(number.cast(f"decimal(28,{digits})")).cast("double")

    sums = F.array(*[F.struct(F.lit(c).alias("column"), F.count(f"`{c}`").alias("filled"), total(c, k).alias("total")) for c, k in kinds])
    return rows.agg(F.count("*").alias("rows"), sums.alias("sums")).select("rows", F.inline("sums")).select(F.lit(name).alias("table"), "column", "rows", "filled", "total")


def csv_sums(spark: SparkSession, path: str, name: str, kinds: list[tuple[str, str]], digits: int = 6) -> DataFrame:
    """``table_sums`` of a written CSV table, whose cells are all read as text."""
    return table_sums(name, spark.read.option("header", True).csv(path), kinds, digits=digits)


def all_rows(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


#: Tables of means and quantiles of correlations of 4 digits, whose own values may lie on ties of 1e-6.
_OF_CORRELATIONS = ("correlation_distribution", "lagged_correlation_summary", "summary_correlation")


@register("analytics_job_tables")
def analytics_job_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole analytics job (C13 to C17) over files: every table it wrote, read back and summed up by column."""
    out = new_folder(spark, "analytics")
    tables = jobs.analytics_job(spark, file_inputs(spark, sf_dir), out)
    del tables["frame"]  # not one of the written tables
    return all_rows([csv_sums(spark, sinks.table_path(out, name), name, table.dtypes, 9 if name in _OF_CORRELATIONS else 6) for name, table in tables.items()])


@register("full_pipeline_tables")
def full_pipeline_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven steps of the full pipeline (C19: population, rainfall, cases, risk, training, prediction, storage) over
    files: every keyed table and the risk CSV files, read back and summed up by column. Ids and times are left out;
    the predicted counts, which depend on the forest, are only counted."""
    base = new_folder(spark, "pipeline")
    jobs.full_pipeline(spark, file_inputs(spark, sf_dir), f"{base}/tables", f"{base}/out", f"{base}/model",
                       prediction_year=PREDICTION_YEAR, num_trees=QUERY_TREES, max_depth=QUERY_DEPTH)
    parts = []
    for name in ("perdistrictpopulation", "rainfall_data", "historicaldata", "risk_levels", "reports"):
        rows = upsert.read_table(spark, sinks.table_path(f"{base}/tables", name)).drop("id", "data_id", "risk_id", "report_id", "calculated_at")
        parts.append(table_sums(name, rows, rows.dtypes, ("case_count",) if name == "reports" else ()))
    weekly = [("year", "int"), ("disease", "string"), ("week_number", "int"), ("area_reported", "string"), ("risk_level", "string"),
              ("incidence_per_100k", "double"), ("lower_threshold", "double"), ("upper_threshold", "double"), ("outbreak_threshold", "double")]
    parts.append(csv_sums(spark, f"{base}/out/weekly_risk_levels", "weekly_risk_levels", weekly))
    thresholds = [*weekly[:2], weekly[3], ("mean_incidence", "double"), ("std_incidence", "double"), ("weeks", "int"), *weekly[6:]]
    parts.append(csv_sums(spark, f"{base}/out/district_thresholds", "district_thresholds", thresholds))
    return all_rows(parts)
