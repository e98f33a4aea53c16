"""Incidence, threshold and risk-band expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casegrid.dims import RISK_PRIORITY, literal_map


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def incidence_per_100k(cases: str | Column, population: str | Column) -> Column:
    """cases / population * 100000; a zero or missing population gives NULL."""
    return F.try_divide(_col(cases).cast("double"), _col(population).cast("double")) * F.lit(100000.0)


def lower_threshold(mean: str | Column, std: str | Column) -> Column:
    """max(mean - std, 0), NULL kept NULL (``greatest`` alone would give 0)."""
    diff = _col(mean) - _col(std)
    return F.when(diff.isNotNull(), F.greatest(diff, F.lit(0.0)))


def upper_threshold(mean: str | Column, std: str | Column) -> Column:
    return _col(mean) + _col(std)


def outbreak_threshold(mean: str | Column, std: str | Column) -> Column:
    return _col(mean) + F.lit(2.0) * _col(std)


def classify_risk(
    incidence: str | Column,
    lower: str | Column,
    upper: str | Column,
    outbreak: str | Column,
) -> Column:
    """Band: any NULL -> Unknown; < lower; <= upper; <= outbreak; else High Risk."""
    inc, lo, up, ob = (_col(x) for x in (incidence, lower, upper, outbreak))
    any_null = inc.isNull() | lo.isNull() | up.isNull() | ob.isNull()
    return (
        F.when(any_null, F.lit("Unknown"))
        .when(inc < lo, F.lit("Below Expected"))
        .when(inc <= up, F.lit("Normal"))
        .when(inc <= ob, F.lit("Warning"))
        .otherwise(F.lit("High Risk"))
    )


def risk_priority(level: str | Column) -> Column:
    """Band -> priority (Unknown 0 .. High Risk 4); unknown labels -> 0."""
    mapping = {k: str(v) for k, v in RISK_PRIORITY.items()}
    return F.coalesce(F.try_element_at(literal_map(mapping), _col(level)).cast("int"), F.lit(0))
