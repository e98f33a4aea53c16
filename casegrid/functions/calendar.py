"""Week / month arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casegrid.dims import MONTH_ORDER, literal_map


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def week_to_month(c: str | Column) -> Column:
    """Fixed bucket: clamp the week to 1..53, month = int((w-1)/53*12)+1."""
    wk = F.least(F.greatest(_col(c).cast("int"), F.lit(1)), F.lit(53))
    return (((wk - 1) / F.lit(53.0)) * F.lit(12.0)).cast("int") + 1


def month_shift(c: str | Column, lag: int | Column) -> Column:
    """Cyclic shift: month ``m`` moves to ``(m + lag - 1) % 12 + 1``."""
    lag_col = lag if isinstance(lag, Column) else F.lit(lag)
    return F.pmod(_col(c) + lag_col - 1, F.lit(12)) + 1


def month_name(c: str | Column) -> Column:
    """1..12 -> ``Jan``..``Dec``; out of range -> NULL."""
    return F.try_element_at(F.array(*[F.lit(m) for m in MONTH_ORDER]), _col(c).cast("int"))


def month_number(c: str | Column) -> Column:
    """``Jan``..``Dec`` -> 1..12; unknown -> NULL."""
    mapping = {m: str(i + 1) for i, m in enumerate(MONTH_ORDER)}
    return F.try_element_at(literal_map(mapping), _col(c)).cast("int")
