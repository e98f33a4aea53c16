"""Rows for the keyed tables and load reports.

Each ``*_rows`` function turns a raw input into the stored table's columns and
keeps ``district_id`` / ``disease_id`` NULL for unknown names, so the load
report can count them before they are rejected (J12).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.dims import Dims
from casegrid.functions.names import legacy_key
from casegrid.functions.numbers import lenient_double, lenient_int, parse_thousands, to_int_half_even
from casegrid.operators.cleaning import lookup_disease, lookup_district, population_ids

HISTORICAL_KEYS = ("week_number", "year", "district_id", "disease_id")
RISK_KEYS = ("district_id", "week_number", "year", "disease_id")
RISK_SET = ("risk_level", "lower_threshold", "upper_threshold", "outbreak_threshold", "risk_score")


def keyed_case_rows(raw: DataFrame, dims: Dims, count_col: str = "cases_reported") -> DataFrame:
    """Case-count rows with ids (C8 / C11 before rejection).

    ``year``, ``week_number`` and the count are parsed leniently; rows with a
    missing one, or a count that no int holds, are dropped; ids are looked up (NULL when
    unknown); the count is rounded half-even to ``case_count``. Keeps ``disease`` (display) for
    per-disease reporting and any ``_row_seq`` for last-row-wins.
    """
    extra = ["_row_seq"] if "_row_seq" in raw.columns else []
    df = raw.select(
        lenient_int(F.col("year")).alias("year"),
        lenient_int(F.col("week_number")).alias("week_number"),
        lenient_double(F.col(count_col)).alias("__count"),
        F.col("area_reported"),
        F.col("disease").alias("__disease_raw"),
        *extra,
    ).na.drop(subset=["year", "week_number", "__count"])
    df = lookup_district(df, "area_reported", dims, district_id="district_id")
    df = lookup_disease(df, "__disease_raw", dims, display="disease", disease_id="disease_id")
    return df.select(
        "week_number", "year", "district_id", "disease_id", "disease",
        to_int_half_even("__count").alias("case_count"), *extra,
    ).na.drop(subset=["case_count"])


def accepted(rows: DataFrame) -> DataFrame:
    """Rows whose district and disease are known."""
    return rows.filter(F.col("district_id").isNotNull() & F.col("disease_id").isNotNull())


def load_report(rows: DataFrame, by: str | None = "disease") -> DataFrame:
    """Attempted / accepted / skipped counts, overall and per ``by``.

    One grouped aggregate (``count_if`` per reason) instead of counters in a
    Python loop; ``by=None`` gives one overall row.
    """
    aggs = [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("district_id").isNotNull() & F.col("disease_id").isNotNull()).alias("accepted"),
        F.count_if(F.col("district_id").isNull()).alias("skipped_unknown_district"),
        F.count_if(F.col("disease_id").isNull()).alias("skipped_unknown_disease"),
    ]
    if by is None:
        return rows.agg(*aggs)
    return rows.groupBy(by).agg(*aggs)


def load_counts(rows: DataFrame) -> dict[str, dict]:
    """``load_report`` by disease as a dict; unknown diseases together, so it is bounded by the dimension."""
    known = F.when(F.col("disease_id").isNotNull(), F.col("disease")).otherwise(F.lit("unknown"))
    return {r["disease"]: r.asDict() for r in load_report(rows.withColumn("disease", known)).collect()}


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def population_rows(raw_population: DataFrame, dims: Dims) -> DataFrame:
    """``district_id, population`` (int, half-even) for known districts."""
    extra = ["_row_seq"] if "_row_seq" in raw_population.columns else []
    df = population_ids(raw_population, dims)
    return df.filter(F.col("district_id").isNotNull()).select(
        "district_id", to_int_half_even("population").alias("population"), *extra
    )


def legacy_population_rows(raw_population: DataFrame, dims: Dims) -> DataFrame:
    """Population rows keyed with the legacy key (S4d): rows with a missing key or
    population are dropped; ``district_id`` is NULL for unknown keys."""
    ids = dims.districts.select(F.col("district_key").alias("__k"), "district_id")
    df = raw_population.select(
        legacy_key("Region", dims.aliases).alias("__k"),
        parse_thousands("Population").alias("population"),
    ).filter(F.col("__k").isNotNull() & F.col("population").isNotNull())
    return df.join(F.broadcast(ids), "__k", "left").select(
        "district_id", to_int_half_even("population").alias("population")
    )


def population_report(raw_population: DataFrame, dims: Dims) -> DataFrame:
    """Rows attempted / skipped for unknown district in a population load."""
    df = population_ids(raw_population, dims)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("district_id").isNull()).alias("skipped_unknown_district"),
    )


def report_rows(predictions: DataFrame, dims: Dims) -> DataFrame:
    """Prediction rows keyed like the ``reports`` table."""
    return keyed_case_rows(predictions, dims, count_col="predicted_cases")
