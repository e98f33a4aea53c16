"""Disease patterns over the analytics frame.

All are grouped aggregates (partial aggregation before the shuffle, so a hot
disease or district is combined map-side). The two window steps run on the
*aggregated* tables (one row per disease x year, or per disease x district),
whose size is bounded by the dimensions, never on raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casegrid.functions.bands import incidence_per_100k
from casegrid.functions.numbers import round_half_even


def hotspots(df: DataFrame) -> DataFrame:
    """Per (disease, year, district): total cases, population, incidence (2 dp) (A2)."""
    agg = df.groupBy("disease", "year", "district").agg(
        F.sum("cases_reported").alias("total_cases"),
        F.max("population").alias("population"),
    )
    return agg.withColumn(
        "incidence_per_100k",
        round_half_even(incidence_per_100k("total_cases", "population"), 2),
    )


def seasonality(df: DataFrame) -> DataFrame:
    """Per (disease, year, week): total and mean cases per district row (A3)."""
    return df.groupBy("disease", "year", "week_number").agg(
        F.sum("cases_reported").alias("total_cases"),
        F.avg("cases_reported").alias("mean_cases_per_district"),
    )


def monthly_profile(df: DataFrame) -> DataFrame:
    """Per (disease, month): total and mean cases (A4)."""
    return df.groupBy("disease", "month").agg(
        F.sum("cases_reported").alias("total_cases"),
        F.avg("cases_reported").alias("mean_cases"),
    )


def annual_totals(df: DataFrame) -> DataFrame:
    """Per (disease, year): total cases (A5)."""
    return df.groupBy("disease", "year").agg(F.sum("cases_reported").alias("total_cases"))


def yoy_change(df: DataFrame) -> DataFrame:
    """Annual totals with the % change from the previous year row of the
    disease (W1). First row NULL; a previous total of 0 gives NULL."""
    totals = annual_totals(df)
    prev = F.lag("total_cases", 1).over(Window.partitionBy("disease").orderBy("year"))
    return totals.withColumn(
        "yoy_pct_change", (F.try_divide(F.col("total_cases"), prev) - F.lit(1.0)) * F.lit(100.0)
    )


def district_totals(hot: DataFrame) -> DataFrame:
    """Hotspot totals over all years per (disease, district)."""
    return hot.groupBy("disease", "district").agg(F.sum("total_cases").alias("total_cases"))


def top_hotspots(hot: DataFrame, n: int = 5) -> DataFrame:
    """Top-``n`` districts per disease by all-year total, ties by name."""
    totals = district_totals(hot)
    w = Window.partitionBy("disease").orderBy(F.desc("total_cases"), F.asc("district"))
    return totals.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def annual_pivot(yoy: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """Disease x year totals, missing -> 0, as integers.

    Pass ``years`` to skip the extra job Spark runs to find the pivot values.
    """
    grouped = yoy.groupBy("disease")
    pivoted = (grouped.pivot("year", list(years)) if years else grouped.pivot("year")).agg(
        F.sum("total_cases")
    )
    value_cols = [c for c in pivoted.columns if c != "disease"]
    return pivoted.select(
        "disease", *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in value_cols]
    )


def annual_grid(yoy: DataFrame, years: Sequence[int] | None = None) -> DataFrame:
    """The pivot's cells as rows: every disease and year with its total, 0 where none."""
    wide = annual_pivot(yoy, years)
    cells = wide.unpivot("disease", [c for c in wide.columns if c != "disease"], "year", "total_cases")
    return cells.withColumn("year", F.col("year").cast("int"))
