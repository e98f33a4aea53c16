"""Operator 4: mixing sources to target weights along a time-varying curriculum.

Every source has a weight and a slope: at training time t in [0, 1] it is drawn at the
rate ``target * (1 + slope * (2 t - 1))``. The integral of that schedule up to t is the
source's cumulative token demand; over the whole run it is the target. The documents of a
source are laid end to end in a fixed pseudo-random order, as often as the target needs,
and each copy's training position is the time at which the demand reaches the copy's
middle (the schedule's integral, inverted in closed form). ``training_order`` range-sorts
by position.

Targets: the sources, by code point with null last, get the weights in turn; they share
``epochs`` times all sizes by weight, no source more than ``most`` times its own size and
no less than ``least`` times it; what a bound takes or adds is shared anew by weight
until every bound holds.

The copy at which a source's target is met is cut there (``whole=False``: it counts with
the words that are missing), or is taken whole if at least half of it is due
(``whole=True``).

The running sum inside a source never gathers a source in one task: its documents are
dealt to cells by a hash, the cells' sums are added up over the small table of cells, and
only the rows of one cell are sorted together.

Edge cases: null text has size 0; null source is a source of its own, last; documents of
size 0 are never taken; repeated rows are separate documents; an empty table or one
without words has no targets above 0 and takes nothing. Columns of ``docs`` may have any
names but the result's own (``mix``, which gives way to a clashing one).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casegrid.llm.common import WORD, free_name, stored

#: About so many documents are sorted together; cells grow in number, not in size.
CELL_ROWS = 256


def sizes(text: F.Column) -> F.Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(per_source: DataFrame, weights: tuple[float, ...] = (3, 1, 2), epochs: float = 1.5, most: float = 2.0, least: float = 0.0) -> DataFrame:
    """source, source_size -> also weight and target.

    ``per_source`` has a row for each source, so the windows here sort sources, not
    documents. With the shared level L, a source takes min(high, max(low, L * weight)).
    The sum of that is a straight line between two neighbouring points at which a source
    meets a bound; the level lies on the line on which the sum is what is wanted.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.array(*[F.lit(float(w)) for w in weights])
    every = Window.partitionBy()
    s = per_source.select(
        "source", "source_size",
        F.get(turn, ((F.row_number().over(by_name) - 1) % len(weights)).cast("int")).alias("weight"),
        (F.lit(float(least)) * F.col("source_size")).alias("low"),
        (F.lit(float(most)) * F.col("source_size")).alias("high"),
        F.sum("source_size").over(every).alias("everything"),
    )
    wanted = F.least(F.greatest(F.lit(float(epochs)) * F.col("everything"), F.sum("low").over(every)), F.sum("high").over(every))
    s = s.select("*", wanted.alias("wanted"))
    # above its lower point a source grows by its weight instead of staying at low; at the upper one it stops, at high
    points = s.select("*", F.explode(F.array(
        F.struct((F.col("low") / F.col("weight")).alias("at"), F.col("weight").alias("slope"), F.lit(0.0).alias("flat"), (-F.col("low")).alias("less")),
        F.struct((F.col("high") / F.col("weight")).alias("at"), (-F.col("weight")).alias("slope"), F.col("high").alias("flat"), F.lit(0.0).alias("less")),
    )).alias("p")).groupBy("p.at").agg(
        F.sum("p.slope").alias("slope"), F.sum(F.col("p.flat") + F.col("p.less")).alias("flat"),
        F.sum(-F.col("p.less")).alias("lows"), F.max("wanted").alias("wanted"),
    )
    upto = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = points.select(
        "at", "wanted", F.lead("at").over(Window.orderBy("at")).alias("next"), F.sum("slope").over(upto).alias("slope"),
        (F.sum("flat").over(upto) + F.sum("lows").over(every)).alias("flat"),
    )
    # the first line that has reached what is wanted where it ends
    reached = F.col("next").isNull() | (F.col("flat") + F.col("slope") * F.col("next") >= F.col("wanted"))
    level = F.when(F.col("slope") > 1e-9, (F.col("wanted") - F.col("flat")) / F.col("slope")).otherwise(F.col("at"))
    level = lines.where(reached).agg(F.min_by(level, "at").alias("level"))
    shared = F.least("high", F.greatest("low", level.scalar() * F.col("weight")))
    return s.select("source", "source_size", "weight", F.coalesce(shared, F.lit(0.0)).alias("target"))


def position(done: F.Column, target: F.Column, slope: F.Column) -> F.Column:
    """The time at which a source's cumulative demand is ``done``: the inverse of target * (t + slope * (t^2 - t))."""
    q = F.least(F.greatest(done / target, F.lit(0.0)), F.lit(1.0))
    one = F.lit(1.0) - slope
    return F.when(F.abs(slope) < 1e-9, q).otherwise((F.sqrt(one * one + 4 * slope * q) - one) / (2 * slope))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    slopes: tuple[float, ...] = (0.5, 0.0, -0.5),
    epochs: float = 1.5,
    most: float = 2.0,
    least: float = 0.0,
    whole: bool = False,
    seed: str = "mix",
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    size_col: str | None = None,
) -> DataFrame:
    """All columns of ``docs`` and ``mix``: struct(size, source_size, target, copies).

    ``copies`` has struct(copy, taken, position) for each time the document is taken, and
    is empty if it isn't. ``size_col``, if given, is used in place of counting words.
    The sums by source and cell are computed at once, into the shared folder.
    """
    name = free_name(docs, "mix")
    size = F.coalesce(F.col(f"`{size_col}`").cast("long"), F.lit(0)) if size_col else sizes(F.col(f"`{text_col}`"))
    rank = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("-"))).cast("binary"))
    digits = max(1, math.ceil(math.log(max(1, docs.count() / CELL_ROWS), 16)))
    # all that is new is in one struct, so that no column of docs can clash
    sized = docs.withColumn(name, F.struct(F.col(f"`{source_col}`").alias("source"), F.substring(rank, 1, digits).alias("cell"), rank.alias("rank"), size.alias("size")))
    m = F.col(name)
    cells = stored(sized.groupBy(m["source"].alias("source"), m["cell"].alias("cell")).agg(F.sum(m["size"]).alias("cell_size")), "cells")
    goals = targets(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")), weights, epochs, most, least)
    before = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    s_, c_, p_ = (free_name(docs, f"{name}_{x}") for x in ("source", "cell", "plan"))
    starts = cells.select(F.col("source").alias(s_), F.col("cell").alias(c_), F.coalesce(F.sum("cell_size").over(before), F.lit(0)).alias("start"))
    slope = F.get(F.array(*[F.lit(float(x)) for x in slopes]), (F.array_position(F.array(*[F.lit(float(w)) for w in weights]), F.col("weight")) - 1).cast("int"))
    plan = starts.join(goals, F.col(s_).eqNullSafe(F.col("source"))).select(s_, c_, F.struct("start", "source_size", "target", slope.alias("slope")).alias(p_))
    joined = sized.join(plan, m["source"].eqNullSafe(F.col(s_)) & (m["cell"] == F.col(c_)), "left")
    in_cell = Window.partitionBy(m["source"], m["cell"]).orderBy(m["rank"], F.col(f"`{id_col}`"), m["size"]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    p = F.col(p_)
    placed = joined.select(*[F.col(f"`{c}`") for c in docs.columns], name, F.struct(
        p["source_size"].alias("source_size"), p["target"].alias("target"), p["slope"].alias("slope"),
        (F.sum(m["size"]).over(in_cell) - m["size"] + p["start"]).alias("before"),
    ).alias(p_))
    return _with_copies(placed, docs.columns, name, p_, most, whole)


def _with_copies(placed: DataFrame, columns: list[str], name: str, plan: str, most: float, whole: bool) -> DataFrame:
    m, p = F.col(name), F.col(plan)

    def copy(k: F.Column) -> F.Column:
        start = p["before"] + k * p["source_size"]
        left = F.least(F.greatest(F.round(p["target"]).cast("long") - start, F.lit(0)), m["size"])
        if whole:
            left = F.when(left * 2 >= m["size"], m["size"]).otherwise(F.lit(0))
        middle = start + m["size"] / F.lit(2.0)
        return F.struct((k + 1).cast("int").alias("copy"), left.cast("long").alias("taken"), position(middle, p["target"], p["slope"]).alias("position"))

    copies = F.filter(F.transform(F.sequence(F.lit(0), F.lit(math.ceil(most) - 1)), copy), lambda c: c["taken"] > 0)
    copies = F.when(p["target"] > 0, copies).otherwise(F.array().cast("array<struct<copy:int,taken:bigint,position:double>>"))
    return placed.select(*[F.col(f"`{c}`") for c in columns], F.struct(m["size"].alias("size"), p["source_size"].alias("source_size"), p["target"].alias("target"), copies.alias("copies")).alias(name))


def training_order(mixed: DataFrame, name: str = "mix", each_copy: bool = True, ties: tuple[str, ...] = (), wordless: bool = False) -> DataFrame:
    """Range-sorted by position: a row for each copy taken, with struct(copy, taken, position) in place of ``name``;
    or, without ``each_copy``, every document once, by its first copy, those that aren't taken last. ``ties`` orders (and parts) rows of one position.
    With ``wordless``, documents of size 0, which a mix never takes, come too, once each, last (position 2)."""
    if each_copy:
        m = F.col(name)
        last = F.array(F.struct(F.lit(1).alias("copy"), F.lit(0).cast("long").alias("taken"), F.lit(2.0).alias("position")))
        copies = F.when(m["size"] == 0, last).otherwise(m["copies"]) if wordless else m["copies"]
        mixed = mixed.withColumn(name, F.explode(copies))
        position = F.col(name)["position"]
    else:
        position = F.coalesce(F.get(F.col(name)["copies"], F.lit(0))["position"], F.lit(2.0))
    order = [position, *[F.col(f"`{c}`") for c in ties]]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order)


def per_document(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken and the training positions of the first and second copy (null where
    not taken) of each document, in training order; the words are counted once."""
    light = stored(docs.select("doc_id", "source", sizes(F.col("text")).alias("size")), "sizes")
    ordered = training_order(mix(light, size_col="size"), each_copy=False, ties=("doc_id",))
    taken = F.aggregate("mix.copies", F.lit(0).cast("long"), lambda total, c: total + c["taken"])
    first, second = (F.get("mix.copies", F.lit(i))["position"] for i in range(2))
    return ordered.select("doc_id", "mix.size", "mix.source_size", "mix.target", taken.alias("taken"), first.alias("first_position"), second.alias("second_position"))


#: The same rows by DuckDB, without cells: windows over whole sources.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('mix:' || COALESCE(CAST(doc_id AS VARCHAR), '-')) AS rank FROM documents),
p AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s AS (
  SELECT source, source_size, CAST([3, 1, 2][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS DOUBLE) AS weight,
         2.0 * source_size::DOUBLE AS high, 1.5::DOUBLE * (SELECT SUM(source_size) FROM p)::DOUBLE AS wanted FROM p),
pt AS (SELECT high / weight AS pos, SUM(weight) AS w, SUM(high) AS h FROM s GROUP BY high / weight),
ln AS (
  SELECT pos, (SELECT SUM(weight) FROM s) - COALESCE(SUM(w) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w,
         COALESCE(SUM(h) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS h FROM pt),
lv AS (SELECT arg_min(level, pos) AS level FROM (SELECT ((SELECT max(wanted) FROM s) - h) / w AS level, pos FROM ln) WHERE level <= pos),
t AS (SELECT source, source_size, COALESCE(least(high, (SELECT level FROM lv) * weight), 0.0) AS target,
             CASE weight WHEN 3 THEN 0.5::DOUBLE WHEN 1 THEN 0::DOUBLE ELSE -0.5::DOUBLE END AS slope FROM s),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.slope, CAST(round(t.target) AS BIGINT) AS due,
         CAST(SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.rank, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (
  SELECT *, least(greatest(due - before, 0), size) AS once, least(greatest(due - before - source_size, 0), size) AS twice,
         least((before + size / 2.0::DOUBLE) / target, 1.0::DOUBLE) AS share,
         least((before + source_size + size / 2.0::DOUBLE) / target, 1.0::DOUBLE) AS share2 FROM r)
SELECT doc_id, size, source_size, target, CAST(once + twice AS BIGINT) AS taken,
       CASE WHEN once > 0 THEN CASE WHEN slope = 0 THEN share
            ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * share) - (1 - slope)) / (2 * slope) END END AS first_position,
       CASE WHEN twice > 0 THEN CASE WHEN slope = 0 THEN share2
            ELSE (sqrt((1 - slope) * (1 - slope) + 4 * slope * share2) - (1 - slope)) / (2 * slope) END END AS second_position
FROM k
"""
