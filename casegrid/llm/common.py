"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casegrid.session import ensure_checkpoint_dir

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of an Arrow batch after ``smaller_batches``; one row at least.
BATCH_BYTES = 4 << 20
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder, through Spark's reader (any file system)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_shared_dir(spark: SparkSession, name: str) -> str:
    """A new path under the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared folder and read back, so a lost executor re-reads files."""
    path = new_shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def smaller_batches(spark: SparkSession) -> None:
    """From now on in this session an Arrow batch takes BATCH_BYTES at most (a smaller limit stays), so what a task holds does not grow with 10,000 texts' length."""
    if 0 < _bytes(spark.conf.get(_BATCH_LIMIT)) <= BATCH_BYTES:
        return
    spark.conf.set(_BATCH_LIMIT, str(BATCH_BYTES))


def _bytes(size: str) -> int:
    """Bytes of a setting such as 64m; 0 if it can't be told."""
    found = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", size.strip().lower())
    return int(found[1]) << 10 * " kmgt".index(found[2] or " ") if found else 0


def release_memory() -> None:
    """Gives back to the system what this worker's allocators hold unused; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A partition function that releases memory at its end."""

    @functools.wraps(run)
    def wrapped(batches):
        yield from run(batches)
        release_memory()

    return wrapped


def ascii_lower(col) -> F.Column:
    """Lower case of A-Z alone."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
