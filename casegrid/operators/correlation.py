"""Rainfall / case correlations.

Pearson r per group is a single grouped aggregate (count, min/max, covar_pop,
stddev_pop — all algebraic, so they combine map-side), not a Python loop per
group. Spark's ``corr`` raises DIVIDE_BY_ZERO under ANSI when a column is
constant, so r is ``try_divide(covar_pop, stddev_pop(x) * stddev_pop(y))`` and
constant groups are removed with ``min < max`` (the source skips groups with
fewer than two distinct values).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.functions.numbers import round_half_even

LAG_COLUMNS = {0: "rainfall_mm", 1: "rainfall_lag1_mm", 2: "rainfall_lag2_mm"}
MIN_PAIRS = 10


def pearson_by_group(
    df: DataFrame,
    group: Sequence[str],
    x: str,
    y: str,
    min_pairs: int = MIN_PAIRS,
    digits: int = 4,
) -> DataFrame:
    """Pearson r of (x, y) per group over rows where both are present (A10).

    Groups with fewer than ``min_pairs`` pairs or a constant side are dropped.
    Output: group columns, ``correlation`` (rounded half-even), ``n_weeks``.
    """
    pairs = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    xc, yc = F.col(x).cast("double"), F.col(y).cast("double")
    agg = pairs.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_weeks"),
        F.min(xc).alias("__xmin"), F.max(xc).alias("__xmax"),
        F.min(yc).alias("__ymin"), F.max(yc).alias("__ymax"),
        F.covar_pop(xc, yc).alias("__cov"),
        F.stddev_pop(xc).alias("__sx"),
        F.stddev_pop(yc).alias("__sy"),
    )
    kept = agg.filter(
        (F.col("n_weeks") >= min_pairs)
        & (F.col("__xmin") < F.col("__xmax"))
        & (F.col("__ymin") < F.col("__ymax"))
    )
    r = F.try_divide(F.col("__cov"), F.col("__sx") * F.col("__sy"))
    return kept.select(
        *group,
        round_half_even(r, digits).alias("correlation"),
        F.col("n_weeks").cast("int").alias("n_weeks"),
    ).filter(F.col("correlation").isNotNull())


def per_district(frame: DataFrame) -> DataFrame:
    """Same-month r of weekly cases vs rainfall per (disease, district) (A10)."""
    return pearson_by_group(frame, ["disease", "district"], "cases_reported", "rainfall_mm")


def lagged(frame: DataFrame) -> DataFrame:
    """r for rainfall lags 0, 1, 2 per (disease, district).

    The three rainfall columns are stacked into rows once (one pass), then a
    single grouped aggregate computes every (disease, district, lag) r.
    """
    stacked = frame.select(
        "disease",
        "district",
        "cases_reported",
        F.inline(
            F.array(*[
                F.struct(F.lit(lag).alias("lag_months"), F.col(c).alias("rain"))
                for lag, c in LAG_COLUMNS.items()
            ])
        ),
    )
    return pearson_by_group(stacked, ["disease", "district", "lag_months"], "cases_reported", "rain")


def summary(corr: DataFrame) -> DataFrame:
    """Per disease: mean and median r and number of districts."""
    return corr.groupBy("disease").agg(
        F.avg("correlation").alias("mean_r"),
        F.median("correlation").alias("median_r"),
        F.count(F.lit(1)).alias("n_districts"),
    )


def lag_summary(lag_corr: DataFrame) -> DataFrame:
    """Per (disease, lag): mean and sample std of r, mean rounded to 3."""
    return lag_corr.groupBy("disease", "lag_months").agg(
        F.avg("correlation").alias("mean_corr"),
        F.stddev_samp("correlation").alias("std_corr"),
        round_half_even(F.avg("correlation"), 3).alias("mean_corr_3dp"),
    )


def lag_pivot(lag_corr: DataFrame) -> DataFrame:
    """Disease x lag mean r (3 dp) with columns ``lag_0mo`` .. ``lag_2mo``."""
    lags = list(LAG_COLUMNS)
    pivoted = lag_corr.groupBy("disease").pivot("lag_months", lags).agg(
        round_half_even(F.avg("correlation"), 3)
    )
    return pivoted.select("disease", *[F.col(str(k)).alias(f"lag_{k}mo") for k in lags])


def distribution(corr: DataFrame) -> DataFrame:
    """Per disease: mean and quartiles of r (box-plot data, A16)."""
    q = F.percentile("correlation", F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    return corr.groupBy("disease").agg(F.avg("correlation").alias("mean_r"), q.alias("q")).select(
        "disease",
        "mean_r",
        *[F.col("q")[i].alias(name) for i, name in enumerate(("min_r", "q1_r", "median_r", "q3_r", "max_r"))],
    )
