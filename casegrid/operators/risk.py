"""Risk bands.

Plan shape: cleaned cases -> join population (broadcast by AQE where its
measured size allows it) -> incidence -> grouped baselines per
(year, disease, district) -> join the baselines back -> banding ``CASE``.
The baselines use a grouped aggregate (partial + final) rather than a window,
so a hot group is combined map-side instead of buffered in one task; the
baseline table has one row per group and is broadcast back by AQE when small,
or sort-merge joined with skew splitting when not.

The surveillance source computes thresholds for one target year; here they
are computed per ``year`` (all years in one pass). Filtering to one year gives
exactly the single-year result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.dims import Dims
from casegrid.functions.bands import (
    classify_risk,
    incidence_per_100k,
    lower_threshold,
    outbreak_threshold,
    risk_priority,
    upper_threshold,
)
from casegrid.functions.numbers import to_int_half_even
from casegrid.operators.cleaning import lookup_disease, lookup_district

GROUP = ("year", "disease", "area_reported")


def risk_base(cases: DataFrame, population: DataFrame) -> DataFrame:
    """Weekly rows with population and incidence.

    ``cases``: ``year, disease, district, week_number, cases_reported`` (zero
    policy); ``population``: ``district, population`` (may hold NULLs).
    Rows whose district has no (valid) population are dropped, as in the
    source (left join, then drop missing population).
    """
    pop = population.select(
        F.col("district").alias("__region"), F.col("population").alias("population")
    )
    # no hint: the population is broadcast where its measured size allows it
    joined = cases.join(pop, F.col("district") == F.col("__region"), "left").filter(
        F.col("population").isNotNull()
    )
    return joined.select(
        "year",
        "disease",
        F.col("district").alias("area_reported"),
        "week_number",
        "cases_reported",
        "population",
        incidence_per_100k("cases_reported", "population").alias("incidence_per_100k"),
    )


def unmatched_areas(cases: DataFrame, population: DataFrame) -> DataFrame:
    """Districts present in the cases but without a population value."""
    valid = population.filter(F.col("population").isNotNull()).select("district")
    return cases.select("district").distinct().join(valid, "district", "left_anti")


def district_thresholds(base: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Baselines per group (A1 + P15).

    mean / sample std (missing std -> 0) of incidence and cases, the group's
    population, number of distinct weeks, and lower / upper / outbreak
    thresholds (mean - std clipped at 0, mean + std, mean + 2 std).
    """
    agg = base.groupBy(*group).agg(
        F.avg("incidence_per_100k").alias("mean_incidence"),
        F.coalesce(F.stddev_samp("incidence_per_100k"), F.lit(0.0)).alias("std_incidence"),
        F.avg("cases_reported").alias("mean_cases"),
        F.coalesce(F.stddev_samp("cases_reported"), F.lit(0.0)).alias("std_cases"),
        F.max("population").alias("population"),
        F.countDistinct("week_number").alias("weeks"),
    )
    return agg.select(
        *group,
        "mean_incidence",
        "std_incidence",
        "mean_cases",
        "std_cases",
        "population",
        F.col("weeks").cast("int").alias("weeks"),
        lower_threshold("mean_incidence", "std_incidence").alias("lower_threshold"),
        upper_threshold("mean_incidence", "std_incidence").alias("upper_threshold"),
        outbreak_threshold("mean_incidence", "std_incidence").alias("outbreak_threshold"),
    )


def weekly_risk(base: DataFrame, thresholds: DataFrame, group: Sequence[str] = GROUP) -> DataFrame:
    """Attach thresholds to every weekly row and band it (J7 + P16)."""
    thr = thresholds.select(
        *[F.col(g).alias(f"__t_{g}") for g in group],
        "lower_threshold", "upper_threshold", "outbreak_threshold",
    )
    # Null-safe keys: pandas merges NaN keys with NaN keys, and a plain equi-join
    # would make Catalyst infer IS NOT NULL filters on the baseline side only,
    # which stops the two uses of ``base`` from sharing one shuffle (exchange reuse).
    cond = [F.col(g).eqNullSafe(F.col(f"__t_{g}")) for g in group]
    out = base.join(thr, cond, "left").drop(*[f"__t_{g}" for g in group])
    return out.withColumn(
        "risk_level",
        classify_risk("incidence_per_100k", "lower_threshold", "upper_threshold", "outbreak_threshold"),
    )


def risk_tables(cases: DataFrame, population: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(thresholds, weekly risk) from cleaned cases and population."""
    base = risk_base(cases, population)
    thresholds = district_thresholds(base)
    return thresholds, weekly_risk(base, thresholds)


def skip_report(weekly: DataFrame, dims: Dims) -> DataFrame:
    """One row: weekly rows, and those that can't be stored because a name is unknown."""
    df = lookup_district(weekly, "area_reported", dims, district_id="district_id")
    df = lookup_disease(df, "disease", dims, disease_id="disease_id")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("district_id").isNull()).alias("skipped_unknown_district"),
        F.count_if(F.col("disease_id").isNull()).alias("skipped_unknown_disease"),
    )


def risk_storage_rows(weekly: DataFrame, dims: Dims, year: int | None = None) -> DataFrame:
    """Rows for the keyed ``risk_levels`` table (C7: P5, P6, P17, W3, P18).

    Ids are looked up, rows with a missing id / threshold / score are dropped,
    one row per (district_id, week_number, year, disease_id) is kept (highest
    priority, then highest score), and the thresholds are rounded half-even to
    integers (the stored contract is integer thresholds).
    The pick-best step is a grouped ``max_by`` (partial aggregation), not a
    sort + window, so duplicate keys are combined map-side.
    """
    df = lookup_district(weekly, "area_reported", dims, district_id="district_id")
    df = lookup_disease(df, "disease", dims, disease_id="disease_id")
    if year is not None:
        df = df.withColumn("year", F.lit(int(year)))
    df = df.select(
        "district_id",
        "week_number",
        F.col("year").cast("int").alias("year"),
        "disease_id",
        "risk_level",
        "lower_threshold",
        "upper_threshold",
        "outbreak_threshold",
        F.col("incidence_per_100k").cast("double").alias("risk_score"),
        risk_priority("risk_level").alias("risk_priority"),
    ).na.drop(
        subset=[
            "district_id", "disease_id", "week_number", "risk_level",
            "lower_threshold", "upper_threshold", "outbreak_threshold", "risk_score",
        ]
    )
    key = ["district_id", "week_number", "year", "disease_id"]
    payload = F.struct(
        "risk_level", "lower_threshold", "upper_threshold", "outbreak_threshold", "risk_score"
    )
    best = df.groupBy(*key).agg(
        F.max_by(payload, F.struct("risk_priority", "risk_score")).alias("p")
    )
    return best.select(
        *key,
        F.col("p.risk_level").alias("risk_level"),
        to_int_half_even("p.lower_threshold").alias("lower_threshold"),
        to_int_half_even("p.upper_threshold").alias("upper_threshold"),
        to_int_half_even("p.outbreak_threshold").alias("outbreak_threshold"),
        F.col("p.risk_score").alias("risk_score"),
    )
