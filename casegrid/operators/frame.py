"""The analytics long frame and its rainfall inputs.

Cases are the fact side; population and rainfall are per-district /
per-(area, month) tables, i.e. bounded by the district dimension (at most
areas x 12 rows), so they are broadcast to the fact rows and the fact side is
never shuffled for these lookups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.dims import MONTH_ORDER, Dims
from casegrid.functions.bands import incidence_per_100k
from casegrid.functions.calendar import month_number, month_shift
from casegrid.functions.names import strip_ws
from casegrid.functions.numbers import parse_thousands
from casegrid.operators.cleaning import lookup_district

LAGS = (1, 2)


def unpivot_months(wide: DataFrame, id_col: str = "District", value_name: str = "avg_rainfall_mm") -> DataFrame:
    """Wide ``Jan..Dec`` columns to rows (R1): ``id, month_name, value``.

    ``DataFrame.unpivot`` keeps NULL values (as pandas ``melt`` does).
    """
    return wide.unpivot([id_col], list(MONTH_ORDER), "month_name", value_name)


def rainfall_long_raw(wide: DataFrame) -> DataFrame:
    """Long rainfall with the *raw* (whitespace-stripped) area name.

    Output ``rainfall_area, month, avg_rainfall_mm``; rows with any missing
    value are dropped.
    """
    long = unpivot_months(wide)
    return long.select(
        strip_ws("District").alias("rainfall_area"),
        month_number("month_name").alias("month"),
        parse_thousands("avg_rainfall_mm").alias("avg_rainfall_mm"),
    ).na.drop("any")


def rainfall_lag_table(rainfall_long: DataFrame, lags: tuple[int, ...] = LAGS) -> DataFrame:
    """(area, month) -> same-month and lagged rainfall, built in one pass.

    Every rainfall row is emitted once per lag at its shifted month, then one
    grouped pivot collects ``rainfall_mm``, ``rainfall_lag1_mm``, ... per
    (area, month). One scan of the rainfall input instead of one per lag, and
    one join for the fact side. Rainfall is keyed by (area, month).
    """
    shifts = [F.struct(F.lit(0).alias("lag"), F.col("month").alias("target"))]
    shifts += [F.struct(F.lit(k).alias("lag"), month_shift("month", k).alias("target")) for k in lags]
    stacked = rainfall_long.select("rainfall_area", "avg_rainfall_mm", F.inline(F.array(*shifts)))
    names = {0: "rainfall_mm", **{k: f"rainfall_lag{k}_mm" for k in lags}}
    return stacked.groupBy("rainfall_area", F.col("target").alias("month")).agg(
        *[F.max(F.when(F.col("lag") == k, F.col("avg_rainfall_mm"))).alias(n) for k, n in names.items()]
    )


def analytics_frame(
    cases: DataFrame,
    population: DataFrame,
    rainfall_long: DataFrame,
    dims: Dims,
) -> DataFrame:
    """Weekly cases with population, same-month and lagged rainfall, incidence.

    ``cases``: ``clean_cases(..., 'drop')``; ``population``: ``district,
    population`` (deduplicated); ``rainfall_long``: ``rainfall_area, month,
    avg_rainfall_mm``. Lag ``k`` attaches month ``m``'s rainfall to month
    ``(m + k - 1) % 12 + 1`` (a climatology wrap, not a time series).
    """
    df = cases.join(population.select("district", "population"), "district", "left")
    df = lookup_district(df, "district", dims, rainfall_area="rainfall_area")
    df = df.join(rainfall_lag_table(rainfall_long), ["rainfall_area", "month"], "left")
    return df.select(
        "year", "disease", "district", "week_number", "month", "cases_reported", "population",
        "rainfall_area", "rainfall_mm", "rainfall_lag1_mm", "rainfall_lag2_mm",
        incidence_per_100k("cases_reported", "population").alias("incidence_per_100k"),
    )
