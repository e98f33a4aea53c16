"""Dimension tables: districts, provinces, diseases, months, risk bands.

The lookups are small, fixed-size DataFrames (a few dozen rows, size known at
plan time), so joins against them are broadcast. Every operator that needs a
lookup takes a :class:`Dims` bundle, so the same code runs on the surveillance
constants below or on dimensions derived from other tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the surveillance source's lookups for equal results)
# ---------------------------------------------------------------------------

# canonical district key -> (district id, display name)
DISTRICTS: dict[str, tuple[int, str]] = {
    "colombo": (1, "Colombo"),
    "gampaha": (2, "Gampaha"),
    "kalutara": (3, "Kalutara"),
    "kandy": (4, "Kandy"),
    "matale": (5, "Matale"),
    "nuwaraeliya": (6, "Nuwara Eliya"),
    "galle": (7, "Galle"),
    "hambantota": (8, "Hambantota"),
    "matara": (9, "Matara"),
    "jaffna": (10, "Jaffna"),
    "kilinochchi": (11, "Kilinochchi"),
    "mannar": (12, "Mannar"),
    "vavuniya": (13, "Vavuniya"),
    "mullaitivu": (14, "Mullaitivu"),
    "batticaloa": (15, "Batticaloa"),
    "ampara": (16, "Ampara"),
    "trincomalee": (17, "Trincomalee"),
    "kurunegala": (18, "Kurunegala"),
    "puttalam": (19, "Puttalam"),
    "anuradhapura": (20, "Anuradhapura"),
    "polonnaruwa": (21, "Polonnaruwa"),
    "badulla": (22, "Badulla"),
    "monaragala": (23, "Monaragala"),
    "ratnapura": (24, "Ratnapura"),
    "kegalle": (25, "Kegalle"),
    "kalmunai": (26, "Kalmunai"),
}

# normalised spelling (after whitespace collapse) -> canonical spelling
DISTRICT_ALIASES: dict[str, str] = {
    "nuwara eliya": "nuwaraeliya",
    "kalmune": "kalmunai",
    "moneragala": "monaragala",
}

# rainfall is reported per area; these districts borrow another area's rainfall
RAINFALL_AREA_REMAP: dict[str, str] = {
    "kalmunai": "Ampara",
}

# province code -> districts (display names), in display order
PROVINCES: dict[str, list[str]] = {
    "W": ["Colombo", "Gampaha", "Kalutara"],
    "C": ["Kandy", "Matale", "Nuwara Eliya"],
    "S": ["Galle", "Hambantota", "Matara"],
    "N": ["Jaffna", "Kilinochchi", "Mannar", "Vavuniya", "Mullaitivu"],
    "E": ["Batticaloa", "Ampara", "Trincomalee", "Kalmunai"],
    "NW": ["Kurunegala", "Puttalam"],
    "NC": ["Anuradhapura", "Polonnaruwa"],
    "U": ["Badulla", "Monaragala"],
    "Sab": ["Ratnapura", "Kegalle"],
}

# disease key -> (disease id, display name)
DISEASES: dict[str, tuple[int, str]] = {
    "dysentery": (1, "Dysentery"),
    "meningitis": (2, "Meningitis"),
    "tuberculosis": (3, "Tuberculosis"),
}

MONTH_ORDER: list[str] = [
    "Jan", "Feb", "Mar", "Apr", "May", "Jun",
    "Jul", "Aug", "Sep", "Oct", "Nov", "Dec",
]

MONTH_LONG_NAMES: list[str] = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]

RISK_PRIORITY: dict[str, int] = {
    "Unknown": 0,
    "Below Expected": 1,
    "Normal": 2,
    "Warning": 3,
    "High Risk": 4,
}

# ---------------------------------------------------------------------------

DISTRICT_SCHEMA = T.StructType([
    T.StructField("district_key", T.StringType(), False),
    T.StructField("district_id", T.IntegerType(), False),
    T.StructField("district_display", T.StringType(), False),
])

DISEASE_SCHEMA = T.StructType([
    T.StructField("disease_key", T.StringType(), False),
    T.StructField("disease_id", T.IntegerType(), False),
    T.StructField("disease_display", T.StringType(), False),
])


@dataclass
class Dims:
    """Lookup bundle used by the name / id / display operators.

    ``districts`` and ``diseases`` are DataFrames with the schemas above; the
    alias and remap tables are small dicts turned into literal maps. When a
    dimension is a fixed literal, ``district_values`` / ``disease_values``
    (key -> (id, display)) hold the same rows and lookups become literal-map
    expressions (no join, inside whole-stage codegen); a dimension read from a
    table is joined (broadcast) instead.
    """

    districts: DataFrame
    diseases: DataFrame
    aliases: dict[str, str] = field(default_factory=dict)
    rainfall_remap: dict[str, str] = field(default_factory=dict)
    provinces: dict[str, list[str]] = field(default_factory=dict)
    # (target district key, template district key) pairs for rainfall backfill
    rainfall_backfill: list[tuple[str, str]] = field(default_factory=list)
    district_values: dict[str, tuple[int, str]] | None = None
    disease_values: dict[str, tuple[int, str]] | None = None


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small constant table as a local relation (no Python-side RDD, so no
    Python worker is started to scan it and the optimizer sees its size)."""
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs))).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def surveillance_dims(spark: SparkSession) -> Dims:
    """The fixed surveillance dimensions as DataFrames."""
    districts = literal_table(
        spark, [(k, i, d) for k, (i, d) in DISTRICTS.items()], DISTRICT_SCHEMA
    )
    diseases = literal_table(
        spark, [(k, i, d) for k, (i, d) in DISEASES.items()], DISEASE_SCHEMA
    )
    return Dims(
        districts=districts,
        diseases=diseases,
        aliases=dict(DISTRICT_ALIASES),
        rainfall_remap=dict(RAINFALL_AREA_REMAP),
        provinces={k: list(v) for k, v in PROVINCES.items()},
        rainfall_backfill=[("kalmunai", "ampara")],
        district_values=dict(DISTRICTS),
        disease_values=dict(DISEASES),
    )


def province_frame(spark: SparkSession, provinces: dict[str, list[str]]) -> DataFrame:
    """District display name -> province code with a display ``sort_order`` (P10)."""
    rows = []
    order = 0
    for code, names in provinces.items():
        for name in names:
            order += 1
            rows.append((name, code, order))
    schema = T.StructType([
        T.StructField("district", T.StringType()),
        T.StructField("province", T.StringType()),
        T.StructField("sort_order", T.IntegerType()),
    ])
    return literal_table(spark, rows, schema)


def month_frame(spark: SparkSession) -> DataFrame:
    """Month number / short name / long name."""
    schema = T.StructType([
        T.StructField("month", T.IntegerType()),
        T.StructField("month_name", T.StringType()),
        T.StructField("month_long", T.StringType()),
    ])
    rows = [(i + 1, s, l) for i, (s, l) in enumerate(zip(MONTH_ORDER, MONTH_LONG_NAMES))]
    return literal_table(spark, rows, schema)


def value_maps(values: dict[str, tuple[int, str]]) -> tuple[F.Column, F.Column]:
    """Literal ``key -> id`` and ``key -> display`` maps from a fixed dimension."""
    ids, names = [], []
    for k, (i, d) in values.items():
        ids.extend([F.lit(k), F.lit(int(i))])
        names.extend([F.lit(k), F.lit(d)])
    return F.create_map(*ids), F.create_map(*names)


def literal_map(mapping: dict) -> F.Column:
    """A literal ``map`` column from a small dict (empty dict -> empty map)."""
    if not mapping:
        return F.create_map().cast(T.MapType(T.StringType(), T.StringType()))
    parts = []
    for k, v in mapping.items():
        parts.extend([F.lit(k), F.lit(v)])
    return F.create_map(*parts)
