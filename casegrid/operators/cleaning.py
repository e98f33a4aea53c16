"""Name lookups and cleaned case / population frames.

A lookup against a fixed literal dimension is a literal-map expression (no
join). A dimension read from a table is a left join against a DataFrame
bounded by the number of districts / diseases, so it is broadcast and the
fact side is never shuffled for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.dims import Dims, literal_map, value_maps
from casegrid.functions.calendar import week_to_month
from casegrid.functions.names import canonical_key, disease_key
from casegrid.functions.numbers import lenient_double, lenient_int, parse_thousands

_KEY = "__district_key"
_DKEY = "__disease_key"


def lookup_district(
    df: DataFrame,
    col: str,
    dims: Dims,
    display: str | None = None,
    district_id: str | None = None,
    rainfall_area: str | None = None,
    key: str | None = None,
) -> DataFrame:
    """Add district outputs for the raw name in ``col``.

    * ``display``: display name; unknown names pass through unchanged (T11),
      a NULL name becomes ``"nan"``.
    * ``district_id``: integer id, NULL when unknown.
    * ``rainfall_area``: display name after the area remap (e.g. a split-off
      district reads its parent area's rainfall).
    * ``key``: the canonical key itself.
    """
    keyed = df.withColumn(_KEY, canonical_key(col, dims.aliases))
    if dims.district_values:
        id_map, name_map = value_maps(dims.district_values)
        joined = keyed
        id_col = F.try_element_at(id_map, F.col(_KEY)).cast("int")
        name_col = F.try_element_at(name_map, F.col(_KEY))
    else:
        d = dims.districts.select(
            F.col("district_key").alias(_KEY),
            F.col("district_id").alias("__district_id"),
            F.col("district_display").alias("__district_display"),
        )
        joined = keyed.join(F.broadcast(d), on=_KEY, how="left")
        id_col, name_col = F.col("__district_id"), F.col("__district_display")
    display_col = F.coalesce(name_col, F.coalesce(F.col(col).cast("string"), F.lit("nan")))
    outputs = []
    if display:
        outputs.append(display_col.alias(display))
    if district_id:
        outputs.append(id_col.alias(district_id))
    if rainfall_area:
        remap = F.try_element_at(literal_map(dims.rainfall_remap), F.col(_KEY)) if dims.rainfall_remap else None
        outputs.append((F.coalesce(remap, display_col) if remap is not None else display_col).alias(rainfall_area))
    if key:
        outputs.append(F.col(_KEY).alias(key))
    produced = {display, district_id, rainfall_area, key} - {None}
    keep = [F.col(c) for c in df.columns if c not in produced]
    # one projection for all outputs (fewer analyzer passes than chained withColumn)
    return joined.select(*keep, *outputs)


def lookup_disease(
    df: DataFrame,
    col: str,
    dims: Dims,
    display: str | None = None,
    disease_id: str | None = None,
) -> DataFrame:
    """Disease display name (unknown passes through) and id (NULL when unknown)."""
    keyed = df.withColumn(_DKEY, disease_key(col))
    if dims.disease_values:
        id_map, name_map = value_maps(dims.disease_values)
        joined = keyed
        id_col = F.try_element_at(id_map, F.col(_DKEY)).cast("int")
        name_col = F.try_element_at(name_map, F.col(_DKEY))
    else:
        d = dims.diseases.select(
            F.col("disease_key").alias(_DKEY),
            F.col("disease_id").alias("__disease_id"),
            F.col("disease_display").alias("__disease_display"),
        )
        joined = keyed.join(F.broadcast(d), on=_DKEY, how="left")
        id_col, name_col = F.col("__disease_id"), F.col("__disease_display")
    outputs = []
    if display:
        outputs.append(F.coalesce(name_col, F.coalesce(F.col(col).cast("string"), F.lit("nan"))).alias(display))
    if disease_id:
        outputs.append(id_col.alias(disease_id))
    produced = {display, disease_id} - {None}
    return joined.select(*[F.col(c) for c in df.columns if c not in produced], *outputs)


def clean_cases(raw: DataFrame, dims: Dims, null_policy: str = "drop") -> DataFrame:
    """Cleaned weekly case frame.

    ``null_policy='zero'``: a blank count is 0 (risk path, T1);
    ``null_policy='drop'``: rows with a blank count are removed (analytics,
    historical and training paths).

    Output: ``year, disease, district, week_number, month, cases_reported``.
    """
    if null_policy not in {"zero", "drop"}:
        raise ValueError("null_policy must be 'zero' or 'drop'")
    cases = lenient_double("cases_reported")
    if null_policy == "zero":
        cases = F.coalesce(cases, F.lit(0.0))
    df = raw.select(
        F.col("year").cast("string").try_cast("int").alias("year"),
        F.col("disease").alias("__disease_raw"),
        lenient_int("week_number").alias("week_number"),
        F.col("area_reported").alias("__area_raw"),
        cases.alias("cases_reported"),
    ).na.drop(subset=["week_number", "cases_reported"])
    df = lookup_district(df, "__area_raw", dims, display="district")
    df = lookup_disease(df, "__disease_raw", dims, display="disease")
    return df.select(
        "year",
        "disease",
        "district",
        "week_number",
        week_to_month("week_number").alias("month"),
        "cases_reported",
    )


def clean_population(
    raw: DataFrame,
    dims: Dims,
    keep_invalid: bool = False,
    dedup: bool = False,
    seq_col: str | None = None,
) -> DataFrame:
    """Population per district.

    Output ``district`` (display name), ``population`` (double). With
    ``keep_invalid`` unparsable rows stay (population NULL); with ``dedup`` the
    first row per district is kept (``seq_col`` orders rows; without it the scan
    order is used). The dedup is a grouped ``min_by`` so a duplicated district
    is collapsed map-side.
    """
    cols = [F.col("Region").alias("__region"), parse_thousands("Population").alias("population")]
    if dedup:
        # scan order: only meaningful directly on a file scan, as here
        cols.append((F.col(seq_col) if seq_col else F.monotonically_increasing_id()).alias("__seq"))
    df = lookup_district(raw.select(*cols), "__region", dims, display="district")
    if not keep_invalid:
        df = df.na.drop(subset=["population"])
    if dedup:
        return df.groupBy("district").agg(F.min_by("population", "__seq").alias("population"))
    return df.select("district", "population")


def population_ids(raw: DataFrame, dims: Dims) -> DataFrame:
    """Population keyed by district id, for the stored population table (S4a):
    unparsable populations dropped, unknown districts reported as NULL id."""
    df = raw.select(
        F.col("Region").alias("Region"),
        parse_thousands("Population").alias("population"),
        *(["_row_seq"] if "_row_seq" in raw.columns else []),
    ).na.drop(subset=["population"])
    return lookup_district(df, "Region", dims, district_id="district_id")


def with_province(df: DataFrame, provinces: DataFrame, district_col: str = "district") -> DataFrame:
    """Attach ``province`` and ``sort_order`` by district display name (P10).

    ``provinces``: ``district, province, sort_order`` (``dims.province_frame``),
    one row per district, so it is broadcast.
    """
    p = provinces.select(F.col("district").alias("__pd"), "province", "sort_order")
    return df.join(F.broadcast(p), F.col(district_col) == F.col("__pd"), "left").drop("__pd")


def null_rows(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is missing, e.g. unparsable populations to report."""
    return df.filter(F.col(col).isNull())
