"""Schema checks that run at analysis time (no Spark job): S6, S13, S14."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


class MissingColumnsError(ValueError):
    """Raised when a frame lacks required columns; lists the missing ones."""


def require_columns(df: DataFrame, required: Iterable[str], what: str = "input") -> DataFrame:
    """Fail early, naming every missing column (S6). Returns ``df`` unchanged."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise MissingColumnsError(f"{what} is missing columns: {missing}")
    return df


def pick_existing_column(df: DataFrame, candidates: Iterable[str]) -> str | None:
    """First candidate that exists in ``df`` (S13), e.g. ``District`` else ``Area``."""
    for name in candidates:
        if name in df.columns:
            return name
    return None


def column_type(df: DataFrame, name: str) -> T.DataType | None:
    """Type of a column, or None when absent."""
    if name not in df.columns:
        return None
    return df.schema[name].dataType


def is_integer_type(dtype: T.DataType | None) -> bool:
    """True for integral id columns: they get sequential ids instead of uuids."""
    return isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
