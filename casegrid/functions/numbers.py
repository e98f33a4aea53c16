"""Numeric parsing and rounding.

Rounding is half-to-even everywhere (``rint``), matching NumPy/pandas; Spark's
``round`` is half-up and is not used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Decimal text; Spark's cast alone would also take ``12d``, ``nan`` or ``inf``.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _number(text: Column) -> Column:
    """Finite decimal text -> double, anything else -> NULL (missing is NULL, never NaN)."""
    value = F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def lenient_double(c: str | Column) -> Column:
    """Numeric cast where unparsable input becomes NULL."""
    return _number(_col(c).cast("string"))


def lenient_int(c: str | Column) -> Column:
    """Numeric cast to int, cut towards zero; unparsable input and what no int holds become NULL."""
    return lenient_double(c).try_cast("int")


def parse_thousands(c: str | Column) -> Column:
    """``"2,375,415"`` -> 2375415.0; unparsable -> NULL."""
    return _number(F.replace(_col(c).cast("string"), F.lit(","), F.lit("")))


def strict_int(c: str | Column) -> Column:
    """Thousands-comma text -> int, half-even; bad input raises under ANSI."""
    cleaned = F.trim(F.replace(_col(c).cast("string"), F.lit(","), F.lit("")))
    return F.rint(cleaned.cast("double")).cast("int")


def round_half_even(c: str | Column, digits: int = 0) -> Column:
    """Half-to-even rounding to ``digits`` decimals, same arithmetic as NumPy."""
    if digits == 0:
        return F.rint(_col(c))
    scale = float(10 ** digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def to_int_half_even(c: str | Column) -> Column:
    """Round half-even and cast to int (NULL stays NULL, what no int holds becomes NULL)."""
    return F.rint(_col(c)).try_cast("int")


def clip_zero_int(c: str | Column) -> Column:
    """Round half-even, clip below at 0, cast to int (P19); what no int holds becomes NULL."""
    return F.greatest(F.rint(_col(c)), F.lit(0.0)).try_cast("int")
