"""Table sinks.

Outputs are written by Spark's committed file writer (task retries and lost
executors are handled by the commit protocol). Sorting is optional and only
applied at write time, so no operator pays for a global sort it doesn't need.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegrid.sources.files import CASE_COLUMNS


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "csv",
    order_by: Sequence[str | Column] | None = None,
    partition_by: Sequence[str] | None = None,
    mode: str = "overwrite",
) -> str:
    """Write ``df`` to ``path`` (CSV with a header, or any Spark format)."""
    out = df.orderBy(*order_by) if order_by else df
    if partition_by and not order_by:
        # few, evenly sized files per output partition; AQE splits hot values
        out = out.hint("rebalance", *partition_by)
    writer = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def write_case_files(
    rows: DataFrame,
    folder: str,
    columns: Sequence[str] = CASE_COLUMNS,
    bom: bool = False,
    quote_all: bool = False,
) -> list[str]:
    """Case rows (year, disease and ``columns``) as ``{year}_{Disease}.csv``, one for each year and disease; returns their paths.

    Each is a folder of CSV files (a large disease is several tasks' work), which ``files.read_case_files``
    takes as it takes a single file. All are written in one job beside ``folder`` and then moved in, a rename for
    each year and disease. ``columns`` gives the header's order, ``bom`` starts each file with a byte order mark
    (not together with ``quote_all``, whose first byte is a quote).
    """
    if bom and quote_all:
        raise ValueError("bom and quote_all exclude each other")
    name = F.concat_ws("_", F.col("year").cast("string"), "disease")
    first = [F.col(c).alias(("\ufeff" if bom and i == 0 else "") + c) for i, c in enumerate(columns)]
    out = rows.select(*first, F.concat(name, F.lit(".csv")).alias("__file")).hint("rebalance", "__file")
    staging = f"{folder.rstrip('/')}.staging-{uuid.uuid4().hex}"
    writer = out.write.partitionBy("__file").option("header", True).option("emptyValue", "").option("quoteAll", quote_all)
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(staging)
    spark = rows.sparkSession
    jvm = spark.sparkContext._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(staging), jvm.org.apache.hadoop.fs.Path(folder)
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    moved = []
    for status in fs.listStatus(source):
        path = status.getPath()
        if not path.getName().startswith("__file="):
            continue
        to = jvm.org.apache.hadoop.fs.Path(target, path.getName().removeprefix("__file="))
        if fs.exists(to):
            raise FileExistsError(to.toString())
        if not fs.rename(path, to):
            raise OSError(f"{path} could not be moved to {to}")
        moved.append(to.toString())
    fs.delete(source, True)
    return sorted(moved)


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def predictions_path(base: str, year: int) -> str:
    """Path convention for a year's predictions."""
    return table_path(base, f"predictions_{int(year)}")
