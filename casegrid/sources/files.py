"""File scans for the surveillance inputs.

Case counts arrive as one CSV per (year, disease) named ``{year}_{Disease}.csv``
with columns ``week_number, area_reported, cases_reported``. All files are read
in ONE scan (one job, split across executors by file and byte range); ``year``
and ``disease`` come from the hidden ``_metadata.file_name`` column. Every value
is read as a string and converted with lenient/strict expressions afterwards,
so a bad cell never fails the read.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegrid.dims import MONTH_ORDER
from casegrid.operators.ordering import with_row_numbers
from casegrid.sources.checks import pick_existing_column, require_columns

CASE_COLUMNS = ("week_number", "area_reported", "cases_reported")
FILE_NAME_PATTERN = r"(\d{4})_([^/]+)\.csv$"
#: The same for a folder of that name, as ``sinks.write_case_files`` writes it.
FOLDER_NAME_PATTERN = r"/(\d{4})_([^/]+)\.csv/[^/]+$"


def _string_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop FileSystem of the path (works for globs)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(conf)
    statuses = fs.globStatus(hpath)
    return statuses is not None and len(statuses) > 0


def resolve_paths(spark: SparkSession, paths: Sequence[str], missing: str = "skip") -> list[str]:
    """Apply a missing-file policy (S3).

    ``skip``: warn and drop missing paths, fail if none is left;
    ``silent``: drop missing paths quietly, fail if none is left;
    ``error``: fail on the first missing path.
    """
    if missing not in {"skip", "silent", "error"}:
        raise ValueError(f"unknown missing-file policy {missing!r}")
    present = []
    for p in paths:
        if path_exists(spark, p):
            present.append(p)
        elif missing == "error":
            raise FileNotFoundError(f"Missing file: {p}")
        elif missing == "skip":
            warnings.warn(f"Skipping missing file: {p}", stacklevel=2)
    if not present:
        raise FileNotFoundError("No input files found")
    return present


def case_file_paths(directory: str, years: Iterable[int], diseases: Iterable[str]) -> list[str]:
    """``{dir}/{year}_{Disease}.csv`` for every (year, disease) pair."""
    return [f"{directory.rstrip('/')}/{y}_{d}.csv" for y in years for d in diseases]


def case_years(spark: SparkSession, directory: str, diseases: Iterable[str]) -> tuple[int, ...]:
    """Years for which the folder holds a ``{year}_{Disease}.csv`` of one of the diseases."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{directory.rstrip('/')}/*_*.csv")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [re.match(FILE_NAME_PATTERN, status.getPath().getName()) for status in fs.globStatus(pattern) or []]
    wanted = set(diseases)
    return tuple(sorted({int(m[1]) for m in names if m and m[2] in wanted}))


def read_case_files(
    spark: SparkSession,
    paths: Sequence[str] | str,
    missing: str = "skip",
) -> DataFrame:
    """Raw case rows from one or many case CSVs.

    Output: ``year int, disease string, week_number, area_reported,
    cases_reported`` (the last three as strings) plus ``_row_seq`` (file path,
    then split offset, then position in the split) for last-row-wins semantics downstream.
    """
    if isinstance(paths, str):
        paths = [paths]
    paths = resolve_paths(spark, list(paths), missing)
    # Files with the same header are read together, so every file's columns go
    # by its own header; every value stays a string (no inference pass).
    by_header: dict[str, list[str]] = {}
    for path, header in _headers(spark, paths).items():
        by_header.setdefault(header, []).append(path)
    parts = [_case_rows(spark, same) for same in by_header.values()]
    return reduce(DataFrame.unionByName, parts)


def _headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """First line of each file that the paths (or patterns) name; of a folder, that of its first file."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = {}
    for path in paths:
        pattern = jvm.org.apache.hadoop.fs.Path(path)
        fs = pattern.getFileSystem(conf)
        for status in fs.globStatus(pattern) or []:
            first = status
            if status.isDirectory():
                inside = sorted((x for x in fs.listStatus(status.getPath()) if x.getPath().getName().startswith("part-")), key=lambda x: x.getPath().getName())
                if not inside:
                    continue
                first = inside[0]
            stream = fs.open(first.getPath())
            try:
                reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
                found[status.getPath().toString()] = (reader.readLine() or "").strip().removeprefix("\ufeff")
            finally:
                stream.close()
    return found


def name_part(number: int) -> F.Column:
    """Year (1) or disease (2) by the name of a scanned case file, or of the folder of that name that it lies in."""
    name, path = F.col("_metadata.file_name"), F.col("_metadata.file_path")
    own = F.regexp_extract(name, FILE_NAME_PATTERN, number)
    return F.when(path.rlike(FOLDER_NAME_PATTERN), F.url_decode(F.regexp_extract(path, FOLDER_NAME_PATTERN, number))).otherwise(own)


def _case_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    raw = (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .csv(paths)
    )
    require_columns(raw, CASE_COLUMNS, "case file")
    return raw.select(
        name_part(1).try_cast("int").alias("year"),
        name_part(2).alias("disease"),
        "week_number",
        "area_reported",
        "cases_reported",
        _row_seq(),
    )


def _row_seq():
    """Place of a row in the files read (to be taken from the scan itself): file path, split offset, position."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"),
    ).alias("_row_seq")


def read_population(spark: SparkSession, path: str) -> DataFrame:
    """Raw population table ``Region, Population`` (both strings)."""
    df = spark.read.option("header", True).csv(path)  # names from the header, values as strings
    require_columns(df, ["Region", "Population"], "population file")
    return df.select("Region", "Population", _row_seq())


def read_rainfall_wide(spark: SparkSession, path: str) -> DataFrame:
    """Raw wide rainfall table (S5): area column ``District`` (or ``Area``,
    renamed to ``District``), ``Jan``..``Dec`` and optionally ``Annual``."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    area = pick_existing_column(df, ["District", "Area"])
    if area is None:
        raise ValueError("rainfall file needs a District or Area column")
    if area != "District":
        df = df.withColumnRenamed(area, "District")
    require_columns(df, ["District", *MONTH_ORDER], "rainfall file")
    keep = ["District", *MONTH_ORDER] + (["Annual"] if "Annual" in df.columns else [])
    return df.select(*[F.col(c).cast("string").alias(c) for c in keep])


def read_predictions(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Prediction table (S9): CSV (all strings) or Parquet, with ``_row_seq``."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Missing file: {path}")
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    df = reader.format(fmt).load(path)
    wanted = ["year", "week_number", "area_reported", "disease", "predicted_cases"]
    require_columns(df, wanted, "predictions")
    return df.select(*wanted, _row_seq())


def read_in_order(spark: SparkSession, path: str, schema: str, name: str = "row_number") -> DataFrame:
    """A written CSV table with the number of each row in its files' order (O1, O2): by file name, then place in the file."""
    rows = spark.read.schema(schema).option("header", True).csv(path)
    columns = rows.columns
    return with_row_numbers(rows.select(*columns, _row_seq()), [F.col("_row_seq")], name).select(*columns, name)


def preview(df: DataFrame, n: int = 5, order: Sequence[str | F.Column] | None = None) -> tuple[int, DataFrame]:
    """Dry-run preview (S11): row count and the first ``n`` rows.

    The first in ``order``; without it, in the order of the files for rows that carry ``_row_seq``; any ``n`` otherwise.
    """
    order = order or ([F.col("_row_seq")] if "_row_seq" in df.columns else None)
    return df.count(), (df.orderBy(*order) if order else df).limit(n)
