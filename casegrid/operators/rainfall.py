"""Rainfall tables.

Rainfall is a per-(area, month) climatology: at most (number of areas) x 12
rows, bounded by the area dimension. The global rankings below (one window
without a partition key) run over the per-area totals only, i.e. one row per
area, never over fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

from casegrid.dims import MONTH_LONG_NAMES, MONTH_ORDER, Dims, literal_table
from casegrid.functions.calendar import month_name, month_number
from casegrid.functions.numbers import parse_thousands, strict_int
from casegrid.operators.cleaning import lookup_district
from casegrid.operators.frame import unpivot_months
from casegrid.operators.ordering import with_row_numbers
from casegrid.sources.checks import require_columns


def monthly_by_district(rain_long: DataFrame) -> DataFrame:
    """``district, month, month_name, avg_rainfall_mm`` (C12) from C3."""
    return rain_long.select(
        F.col("rainfall_area").alias("district"),
        F.col("month").cast("int").alias("month"),
        month_name("month").alias("month_name"),
        "avg_rainfall_mm",
    )


def district_totals_ranked(monthly: DataFrame) -> DataFrame:
    """Sum of months per district, ranked wettest first (A7 + W2).

    Ties get distinct ranks (by name), like a positional rank after a sort; the ranks are
    row numbers of a range sort, so no task holds all districts.
    """
    totals = monthly.groupBy("district").agg(F.sum("avg_rainfall_mm").alias("annual_rainfall_mm"))
    ranked = with_row_numbers(totals, [F.desc("annual_rainfall_mm"), F.asc("district")], "rank")
    return ranked.withColumn("rank", F.col("rank").cast("int"))


def extremes(ranked: DataFrame, n: int = 5) -> DataFrame:
    """Wettest ``n`` and driest ``n`` districts with a ``label`` (O3)."""
    # the rank is a total order, so its far end holds the driest
    wet = ranked.filter(F.col("rank") <= n).withColumn("label", F.lit("wettest"))
    dry = ranked.orderBy(F.desc("rank")).limit(n).withColumn("label", F.lit("driest"))
    return wet.unionByName(dry).select("label", "district", "annual_rainfall_mm", "rank")


def peak_months(monthly: DataFrame) -> DataFrame:
    """Wettest month per district; ties go to the earliest month."""
    return monthly.groupBy("district").agg(
        F.max_by("month_name", F.struct(F.col("avg_rainfall_mm"), -F.col("month"))).alias("peak_month"),
        F.max("avg_rainfall_mm").alias("peak_rainfall_mm"),
    )


def heatmap(monthly: DataFrame) -> DataFrame:
    """District x month pivot in calendar order (R2); explicit values, one job."""
    return monthly.groupBy("district").pivot("month_name", list(MONTH_ORDER)).agg(
        F.first("avg_rainfall_mm")
    )


def features(wide: DataFrame, dims: Dims) -> tuple[DataFrame, DataFrame]:
    """Model features (C4, A8, A9): (annual by area key, national mean by month).

    Area names are canonicalised here (unlike C3), with the area remap.
    Annual: the ``Annual`` column (first valid row per area) when present,
    else the mean of the months.
    """
    long = unpivot_months(wide)
    long = lookup_district(long, "District", dims, rainfall_area="area_key").select(
        "area_key",
        month_number("month_name").alias("month"),
        parse_thousands("avg_rainfall_mm").alias("avg_rainfall_mm"),
    )
    if "Annual" in wide.columns:
        annual = lookup_district(
            wide.select("District", parse_thousands("Annual").alias("annual"),
                        F.monotonically_increasing_id().alias("__seq")),
            "District", dims, rainfall_area="area_key",
        ).filter(F.col("annual").isNotNull())
        annual = annual.groupBy("area_key").agg(
            F.min_by("annual", "__seq").alias("avg_annual_rainfall_mm")
        )
    else:
        annual = long.groupBy("area_key").agg(F.avg("avg_rainfall_mm").alias("avg_annual_rainfall_mm"))
    national = long.groupBy("month").agg(F.avg("avg_rainfall_mm").alias("national_avg_rainfall_mm"))
    return annual, national


def storage_rows(wide: DataFrame, dims: Dims, seq_col: str | None = None) -> DataFrame:
    """Rows for the keyed ``rainfall_data`` table (C10: P3, P5, P22, U3, U2).

    One row per known district: ``district_id``, ``january``..``december`` and
    ``annual_rainfall`` as integers (strict parse, half-even; bad text raises).
    The last row of a district wins (by ``seq_col``; by scan order without it);
    each (target, template) backfill pair copies the template's row to a target
    that has none. One pass: a row is emitted for its district and for the
    district it may stand in for, and a district's own rows win.
    """
    require_columns(wide, ["District", *MONTH_ORDER, "Annual"], "rainfall load")
    seq = F.col(seq_col) if seq_col else F.monotonically_increasing_id()
    df = wide.select("District", *MONTH_ORDER, "Annual", seq.alias("__seq"))
    df = lookup_district(df, "District", dims, district_id="district_id").filter(
        F.col("district_id").isNotNull()
    )
    values = [strict_int(m).alias(long) for m, long in zip(MONTH_ORDER, MONTH_LONG_NAMES)]
    values.append(strict_int("Annual").alias("annual_rainfall"))
    df = df.select("district_id", F.lit(True).alias("__own"), "__seq", F.struct(*values).alias("v"))
    if dims.rainfall_backfill:
        df = _with_stand_ins(df, dims)
    last = df.groupBy("district_id").agg(F.max_by("v", F.struct("__own", "__seq")).alias("v"))
    return last.select("district_id", "v.*")


def _with_stand_ins(df: DataFrame, dims: Dims) -> DataFrame:
    """The rows, and a copy (``__own`` false) of each template's for its target (both from the fixed lookups)."""
    ids = dims.districts.select("district_key", "district_id")
    pairs = (
        _pairs_frame(dims).join(F.broadcast(ids.withColumnRenamed("district_key", "target_key")
                               .withColumnRenamed("district_id", "target_id")), "target_key")
        .join(F.broadcast(ids.withColumnRenamed("district_key", "template_key")
                          .withColumnRenamed("district_id", "template_id")), "template_key")
        .groupBy("template_id").agg(F.collect_set("target_id").alias("target_ids"))
    )
    own = F.array(F.struct(F.col("district_id"), F.lit(True).alias("__own")))
    copies = F.transform(F.coalesce("target_ids", F.array().cast("array<int>")),
                         lambda t: F.struct(t.alias("district_id"), F.lit(False).alias("__own")))
    joined = df.join(F.broadcast(pairs), F.col("district_id") == F.col("template_id"), "left")
    return joined.select(F.inline(F.concat(own, copies)), "__seq", "v")


def _pairs_frame(dims: Dims) -> DataFrame:
    schema = T.StructType([
        T.StructField("target_key", T.StringType()),
        T.StructField("template_key", T.StringType()),
    ])
    return literal_table(dims.districts.sparkSession, list(dims.rainfall_backfill), schema)


def missing_districts(rows: DataFrame, dims: Dims) -> DataFrame:
    """Districts of the dimension without a stored rainfall row."""
    return dims.districts.select("district_id", F.col("district_display").alias("district")).join(
        rows.select("district_id"), "district_id", "left_anti"
    )
