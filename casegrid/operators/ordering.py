"""Row numbers over a whole table, without a window in one task.

``with_row_numbers`` sorts by ranges: Spark samples the order's columns, deals rows to
partitions of successive ranges (a hot key is split where the further columns differ) and
sorts each partition. The rows are written once with their place in their partition; a
partition's first number is the sum of the sizes of those before it (a row for each
partition, no more, goes through the driver).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casegrid.session import materialize


def with_row_numbers(df: DataFrame, order: Sequence[Column], name: str = "row_number", within: Sequence[str] = ()) -> DataFrame:
    """All columns and ``name``: 1, 2, ... in ``order``, or anew for each value of the ``within`` columns, which then come first in ``order`` (ascending).

    Rows that ``order`` does not tell apart are numbered in any order; null values of
    ``within`` are one value. An empty table stays empty.
    """
    place, part, first = (_free(df, x) for x in ("place", "part", "first_number"))
    keys = [F.col(f"`{c}`") for c in within]
    dealt = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    rows = materialize(dealt.withColumn(place, F.monotonically_increasing_id()), "ordered")
    in_part = F.shiftright(place, 33)  # the id's upper bits are the partition, the others count its rows
    sizes = sorted((r["part"], r["n"]) for r in rows.groupBy(in_part.alias("part")).agg(F.count("*").alias("n")).collect())
    firsts, total = [], 0
    for number, n in sizes:
        firsts.append((number, total))
        total += n
    offsets = df.sparkSession.createDataFrame(firsts, f"{part} long, {first} long")  # a row for each partition
    numbered = rows.join(F.broadcast(offsets), in_part == F.col(part)).withColumn(name, F.col(first) + F.col(place) - F.shiftleft(in_part, 33) + 1).drop(part, first, place)
    if not within:
        return numbered
    lowest = numbered.groupBy(*keys).agg(F.min(name).alias(first)).select(*[k.alias(f"{first}_{i}") for i, k in enumerate(keys)], first)
    same = F.lit(True)
    for i, c in enumerate(within):
        same = same & numbered[f"`{c}`"].eqNullSafe(F.col(f"{first}_{i}"))
    return numbered.join(lowest, same).withColumn(name, F.col(name) - F.col(first) + 1).drop(first, *[f"{first}_{i}" for i in range(len(within))])


def _free(df: DataFrame, base: str) -> str:
    taken = {c.lower() for c in df.columns}
    while base in taken:
        base += "_"
    return base
