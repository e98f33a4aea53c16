"""Name normalisation expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casegrid.dims import literal_map


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: str | Column) -> Column:
    """Strip leading/trailing whitespace of any kind (``trim`` only removes spaces)."""
    return F.regexp_replace(_col(c).cast("string"), r"(?U)^\s+|\s+$", "")


def canonical_key(c: str | Column, aliases: dict[str, str] | None = None) -> Column:
    """Canonical district key: strip, lower-case, ``_``/``-`` to space, collapse
    whitespace, apply the alias table, drop spaces. NULL becomes ``""``."""
    text = F.lower(strip_ws(F.coalesce(_col(c).cast("string"), F.lit(""))))
    text = F.translate(text, "_-", "  ")
    text = F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), r"^ | $", "")
    if aliases:
        text = F.coalesce(F.try_element_at(literal_map(aliases), text), text)
    return F.replace(text, F.lit(" "), F.lit(""))


def disease_key(c: str | Column) -> Column:
    """Disease key: strip and lower-case; NULL becomes ``""``."""
    return F.lower(strip_ws(F.coalesce(_col(c).cast("string"), F.lit(""))))


def legacy_key(c: str | Column, aliases: dict[str, str] | None = None) -> Column:
    """Older, simpler district key (S4d): strip, lower-case, alias, drop spaces.

    Unlike :func:`canonical_key` it does not turn ``_`` / ``-`` into spaces or
    collapse runs of whitespace before the alias lookup, and a missing name
    becomes ``"nan"`` (kept, with an unknown id) rather than being dropped.
    """
    text = F.lower(strip_ws(F.coalesce(_col(c).cast("string"), F.lit("nan"))))
    if aliases:
        text = F.coalesce(F.try_element_at(literal_map(aliases), text), text)
    return F.replace(text, F.lit(" "), F.lit(""))
