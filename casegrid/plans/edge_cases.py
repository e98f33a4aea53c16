"""Registered queries on faulty inputs: the cases that the clean projection never has.

Each one puts faults into the projected rows by a rule (no rows are made up): unknown names,
bad numbers, districts without population or rainfall, repeated keys, groups too small or
constant. Importing this module adds them to ``catalog.QUERIES``; their SQL is in
``casegrid.oracle_edges``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.functions.bands import classify_risk
from casegrid.functions.numbers import clip_zero_int
from casegrid.operators import cleaning, correlation, forecast, loads, rainfall, risk, upsert
from casegrid.plans.catalog import (
    PREDICTION_YEAR,
    QUERIES,
    analytics,
    clean_cases,
    historical_rows,
    r6,
    register,
    risk_frames,
    shared,
    training,
)
from casegrid.sources import testdata as td

__all__ = ["QUERIES"]

HOLDOUT, HOLDOUT_SEED = 0.2, 42


# ---------------------------------------------------------------- unknown names, bad numbers


@shared
def faulty_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw case rows with a fault that depends on the last digit of the week.

    3: a count like ``12d``; 4: the count ``nan``; 5: an unknown district; 6: the count
    ``inf``; 7: an unknown disease; 8: a no-break space in the district.
    """
    raw = td.raw_cases(spark, sf_dir)
    digit = F.pmod(F.col("week_number").cast("int"), F.lit(10))
    count = (
        F.when(digit == 3, F.concat("cases_reported", F.lit("d")))
        .when(digit == 4, F.lit("nan"))
        .when(digit == 6, F.lit("inf"))
        .otherwise(F.col("cases_reported"))
    )
    area = (
        F.when(digit == 5, F.concat(F.lit("Old "), "area_reported"))
        .when(digit == 8, F.replace("area_reported", F.lit("_"), F.lit("\u00a0")))
        .otherwise(F.col("area_reported"))
    )
    disease = F.when(digit == 7, F.lit("X")).otherwise(F.col("disease"))
    return raw.select("year", disease.alias("disease"), "week_number", area.alias("area_reported"),
                      count.alias("cases_reported"))


@register("load_report_faulty")
def load_report_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loads.load_report(loads.keyed_case_rows(faulty_cases(spark, sf_dir), td.dims(spark, sf_dir)))


@register("clean_cases_faulty")
def clean_cases_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_cases(faulty_cases(spark, sf_dir), td.dims(spark, sf_dir), "zero")


# ---------------------------------------------------------------- population gaps and repeats


@shared
def gappy_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population without NATION_3, and with the text ``nan`` for NATION_4."""
    raw = td.raw_population(spark, sf_dir).filter(F.lower("Region") != "nation_3")
    text = F.when(F.lower("Region") == "nation_4", F.lit("nan")).otherwise(F.col("Population"))
    return cleaning.clean_population(raw.select("Region", text.alias("Population")), td.dims(spark, sf_dir),
                                     keep_invalid=True)


@register("unmatched_areas_gaps")
def unmatched_areas_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk.unmatched_areas(clean_cases(spark, sf_dir, "zero"), gappy_population(spark, sf_dir))


@register("invalid_population_rows")
def invalid_population_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.null_rows(gappy_population(spark, sf_dir), "population")


@shared
def repeated_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows for most districts, spelled in two ways: the older population, then the current one."""
    older = td.raw_population(spark, sf_dir, positive_balance_only=True)
    current = td.raw_population(spark, sf_dir).withColumn("Region", F.replace("Region", F.lit("_"), F.lit(" ")))
    return older.withColumn("_row_seq", F.lit(1)).unionByName(current.withColumn("_row_seq", F.lit(2)))


@register("population_first_row")
def population_first_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analytics table keeps a district's first row."""
    return cleaning.clean_population(repeated_population(spark, sf_dir), td.dims(spark, sf_dir), dedup=True,
                                     seq_col="_row_seq")


@register("population_last_row")
def population_last_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table keeps a district's last row (C9), also when the batch is loaded twice."""
    batch = loads.population_rows(repeated_population(spark, sf_dir), td.dims(spark, sf_dir))
    empty = batch.limit(0).select("district_id", "population", F.lit(None).cast("string").alias("id"))
    merged = empty
    for _ in range(2):
        merged = upsert.merge_upsert(merged.select("district_id", "population", "id"), batch, ["district_id"],
                                     ["population"], id_col="id", seq_col="_row_seq", with_action=True)
    return merged.select("district_id", "population", F.col("id").isNotNull().alias("has_id"), upsert.ACTION_COL)


# ---------------------------------------------------------------- risk


@register("risk_best_row")
def risk_best_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key twice: a second row with 1.5 times the incidence in odd weeks, half of it in
    even ones. The higher band stays, then the higher score (W3, P17)."""
    _, weekly = risk_frames(spark, sf_dir)
    factor = F.when(F.pmod("week_number", F.lit(2)) == 1, F.lit(1.5)).otherwise(F.lit(0.5))
    other = weekly.withColumn("incidence_per_100k", F.col("incidence_per_100k") * factor).withColumn(
        "risk_level",
        classify_risk("incidence_per_100k", "lower_threshold", "upper_threshold", "outbreak_threshold"),
    )
    rows = risk.risk_storage_rows(weekly.unionByName(other), td.dims(spark, sf_dir))
    return rows.withColumn("risk_score", r6("risk_score"))


@register("risk_skips")
def risk_skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly rows of two districts and a disease spelled so that no dimension knows them."""
    _, weekly = risk_frames(spark, sf_dir)
    area = F.when(F.col("area_reported").isin("NATION_5", "NATION_6"), F.lit("Elsewhere")).otherwise(F.col("area_reported"))
    disease = F.when(F.col("disease") == "P", F.lit("Q")).otherwise(F.col("disease"))
    return risk.skip_report(weekly.withColumn("area_reported", area).withColumn("disease", disease),
                            td.dims(spark, sf_dir))


# ---------------------------------------------------------------- rainfall gaps and repeats


@shared
def gappy_rainfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Storage rows without NATION_2, NATION_1 given twice: the current row, then an older one."""
    current = td.raw_rainfall_wide(spark, sf_dir).filter(F.col("District") != "NATION_2")
    older = td.raw_rainfall_wide(spark, sf_dir, 1998).filter(F.col("District") == "NATION_1")
    wide = current.withColumn("seq", F.lit(1)).unionByName(older.withColumn("seq", F.lit(2)))
    return rainfall.storage_rows(wide, td.dims(spark, sf_dir), seq_col="seq")


@register("rain_backfill_gaps")
def rain_backfill_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gappy_rainfall(spark, sf_dir)


@register("rain_missing_areas_gaps")
def rain_missing_areas_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rainfall.missing_districts(gappy_rainfall(spark, sf_dir), td.dims(spark, sf_dir))


# ---------------------------------------------------------------- correlation guards


@register("rain_case_corr_guards")
def rain_case_corr_guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NATION_7 has a constant count and NATION_8 rainfall in week 1 only: both drop out."""
    df = analytics(spark, sf_dir)
    cases = F.when(F.col("district") == "NATION_7", F.lit(5.0)).otherwise(F.col("cases_reported"))
    rain = F.when((F.col("district") != "NATION_8") | (F.col("week_number") == 1), F.col("rainfall_mm"))
    return correlation.per_district(df.withColumn("cases_reported", cases).withColumn("rainfall_mm", rain))


# ---------------------------------------------------------------- forecast parts


@register("holdout_split")
def holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash split of the training rows (M2)."""
    train, test = forecast.split_holdout(training(spark, sf_dir), HOLDOUT, HOLDOUT_SEED, "hash")
    key = ["year", "week_number", "area_reported", "disease"]
    return train.select(*key, F.lit(False).alias("in_test")).unionByName(test.select(*key, F.lit(True).alias("in_test")))


@register("holdout_error")
def holdout_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAE and RMSE (A18) of a fixed predictor: the training mean of a district and disease."""
    train, test = forecast.split_holdout(training(spark, sf_dir), HOLDOUT, HOLDOUT_SEED, "hash")
    means = train.groupBy("area_reported", "disease").agg(F.avg(forecast.LABEL).alias("prediction"))
    out = forecast.error_metrics(test.join(means, ["area_reported", "disease"]))
    return out.select("test_rows", r6("mae").alias("mae"), r6("rmse").alias("rmse"))


@register("one_hot_columns")
def one_hot_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encoders' columns (R5, R6): position of each category's 1; the first category in name order has none."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    rows = training(spark, sf_dir).select(*forecast.CATEGORICAL).distinct()
    encoders = Pipeline(stages=forecast.build_pipeline().getStages()[:2]).fit(rows)
    encoded = encoders.transform(rows)
    parts = []
    for c in forecast.CATEGORICAL:
        vector = vector_to_array(f"{c}_ohe")
        parts.append(encoded.select(
            F.lit(c).alias("feature"), F.col(c).alias("category"), F.size(vector).alias("width"),
            F.array_position(vector, F.lit(1.0)).cast("int").alias("position"),
        ).distinct())
    return parts[0].unionByName(parts[1])


@register("upsert_reports_fixed")
def upsert_reports_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports (C11, P19) with fixed predictions in the forest's place: a week's mean count less
    40.25, for the last data year (updates) and the next one (inserts)."""
    dims = td.dims(spark, sf_dir)
    means = clean_cases(spark, sf_dir, "drop").groupBy("district", "disease", "week_number").agg(
        F.avg("cases_reported").alias("mean")
    )
    predictions = means.select(
        F.explode(F.array(F.lit(PREDICTION_YEAR - 1), F.lit(PREDICTION_YEAR))).alias("year"),
        "week_number", F.col("district").alias("area_reported"), "disease",
        clip_zero_int(F.col("mean") - F.lit(40.25)).alias("predicted_cases"),
    )
    batch = loads.accepted(loads.report_rows(predictions, dims)).drop("disease")
    target = historical_rows(spark, sf_dir).drop("disease").withColumn("report_id", F.expr("uuid()"))
    merged = upsert.merge_upsert(target, batch, loads.HISTORICAL_KEYS, ["case_count"], id_col="report_id", with_action=True)
    return merged.select(*loads.HISTORICAL_KEYS, "case_count", F.col("report_id").isNotNull().alias("has_id"),
                         upsert.ACTION_COL)
