"""Keyed upsert on plain files.

``merge_upsert`` is a pure DataFrame function: deduplicate the batch (last row
per key wins), full-outer-join it with the target on the key columns, take the
batch's values where it has the key and keep the target's otherwise. Existing
rows keep their surrogate id; new rows get a fresh one. Running the same batch
twice leaves the table unchanged (idempotent), except the touch timestamp.

The batch dedup is a grouped ``max_by`` (partial aggregation: a hot key is
combined map-side). The merge is a full outer join, which Spark runs as a
shuffle join on the keys; after the dedup each key occurs at most once per
side, so no key can be skewed there.

``upsert_table`` persists the result. Unpartitioned tables are written to a
staging folder next to the target (same shared file system) and swapped in,
because a Spark job cannot overwrite the folder it is reading. The swap is two
renames; a run stopped between them leaves the old rows under ``{path}.old``,
which ``read_table`` reads and the next upsert puts back. One writer at a time
per table. A partitioned upsert replaces its partitions one by one at job
commit; run it again after a stop, the result is the same. Tables
partitioned by part of the key (e.g. ``year``) only read and rewrite the
partitions a batch touches, with dynamic partition overwrite.
"""

from __future__ import annotations

import uuid as _uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from casegrid.sources.checks import column_type, is_integer_type, require_columns

ACTION_COL = "_merge_action"


def dedup_last(batch: DataFrame, keys: Sequence[str], seq_col: str | None) -> DataFrame:
    """One row per key: the row with the highest ``seq_col`` (last in batch order).

    Without ``seq_col`` there is no last row, so a repeated key is an error.
    """
    others = [c for c in batch.columns if c not in keys and c != seq_col]
    if seq_col is None:
        one = batch.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("__n"), *[F.any_value(c).alias(c) for c in others]
        )
        message = F.concat(F.lit("more than one row of the batch has the key "), F.to_json(F.struct(*keys)))
        checked = F.when(F.col("__n") > 1, F.raise_error(message)).otherwise(F.lit(True))
        return one.filter(checked.cast("boolean")).select(*batch.columns)
    if not others:
        return batch.select(*keys).distinct()
    best = batch.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(seq_col)).alias("__v"))
    return best.select(*keys, *[F.col(f"__v.{c}").alias(c) for c in others])


def merge_upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    set_cols: Sequence[str],
    id_col: str | None = None,
    touch_col: str | None = None,
    seq_col: str | None = None,
    with_action: bool = False,
) -> DataFrame:
    """Merged table = target upserted with batch (``INSERT .. ON CONFLICT DO UPDATE``).

    * ``keys``: the unique key; ``set_cols``: columns overwritten on conflict.
    * ``id_col``: surrogate id kept for existing rows; new rows get a uuid, or,
      when the target's id column is integral, the next free numbers, dense.
    * ``touch_col``: set to ``current_timestamp()`` on inserted / updated rows.
    * ``seq_col``: batch ordering column for last-row-wins dedup.
    * ``with_action``: add ``_merge_action`` in {insert, update, keep}.
    """
    keys, set_cols = list(keys), list(set_cols)
    require_columns(batch, keys + set_cols, "upsert batch")
    require_columns(target, keys + set_cols, "upsert target")
    b = dedup_last(batch.select(*keys, *set_cols, *([seq_col] if seq_col else [])), keys, seq_col)
    b = b.select(*[F.col(k).alias(f"__b_{k}") for k in keys],
                 *[F.col(c).alias(f"__b_{c}") for c in set_cols],
                 F.lit(True).alias("__in_batch"))
    cond = [F.col(k) == F.col(f"__b_{k}") for k in keys]
    if id_col and is_integer_type(column_type(target, id_col)):
        b = _numbered(target, b, cond, [f"__b_{k}" for k in keys], id_col)
    t = target.withColumn("__in_target", F.lit(True))
    j = t.join(b, cond, "full_outer")
    in_b = F.col("__in_batch").isNotNull()
    in_t = F.col("__in_target").isNotNull()

    out_cols = []
    for c in target.columns:
        if c in keys:
            out_cols.append(F.when(in_t, F.col(c)).otherwise(F.col(f"__b_{c}")).alias(c))
        elif c in set_cols:
            out_cols.append(
                F.when(in_b, F.col(f"__b_{c}")).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
            )
        elif c == id_col:
            out_cols.append(_new_id(target, id_col, in_t).alias(c))
        elif c == touch_col:
            out_cols.append(
                F.when(in_b, F.current_timestamp()).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
            )
        else:
            out_cols.append(F.col(c))
    if with_action:
        out_cols.append(
            F.when(in_b & in_t, F.lit("update")).when(in_b, F.lit("insert")).otherwise(F.lit("keep")).alias(ACTION_COL)
        )
    return j.select(*out_cols)


def _new_id(target: DataFrame, id_col: str, in_t):
    dtype = column_type(target, id_col)
    if is_integer_type(dtype):
        # the numbers were given to the batch's new rows before the merge
        return F.when(in_t, F.col(id_col)).otherwise((target.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar() + F.col("__rank")).cast(dtype))
    return F.when(in_t, F.col(id_col)).otherwise(F.expr("uuid()"))


#: New rows are numbered inside so many hash buckets; the buckets' counts are a table of this size.
ID_BUCKETS = 1024


def _numbered(target: DataFrame, b: DataFrame, cond: list, b_keys: list[str], id_col: str) -> DataFrame:
    """The batch with ``__rank``: 1, 2, ... over its rows that the target lacks (NULL for the others).

    Running counts of hash buckets, then a rank inside each bucket: dense numbers, and no task sees all new rows.
    """
    new = b.join(target, cond, "left_anti").select(*b_keys)
    new = new.withColumn("__bucket", F.pmod(F.xxhash64(*b_keys), F.lit(ID_BUCKETS)))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = new.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n")).select(
        "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    )
    inside = F.row_number().over(Window.partitionBy("__bucket").orderBy(*b_keys))
    ranks = new.join(starts, "__bucket").select(*b_keys, (F.col("__start") + inside).alias("__rank"))
    return b.join(ranks, b_keys, "left")


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _hadoop_fs(spark, path)
    return bool(fs.exists(hpath))


def _backup(path: str) -> str:
    return f"{path.rstrip('/')}.old"


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The stored table, also when a run was stopped in the middle of a swap."""
    if not table_exists(spark, path) and table_exists(spark, _backup(path)):
        path = _backup(path)
    return spark.read.format(fmt).load(path)


def recover(spark: SparkSession, path: str) -> None:
    """Finish or undo a swap that a stopped run left behind (for the table's writer only)."""
    fs, target = _hadoop_fs(spark, path)
    _, backup = _hadoop_fs(spark, _backup(path))
    if fs.exists(backup):
        if fs.exists(target):
            fs.delete(backup, True)
        elif not fs.rename(backup, target):
            raise OSError(f"could not put {path} back")


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    set_cols: Sequence[str],
    id_col: str | None = None,
    touch_col: str | None = None,
    seq_col: str | None = None,
    fmt: str = "parquet",
    partition_cols: Sequence[str] | None = None,
) -> dict:
    """Upsert ``batch`` into the table stored at ``path`` and report counts.

    Unpartitioned: the merged table is written to ``{path}.staging-<uuid>`` and
    swapped in only after the write job has committed, so a failed run leaves
    the old table.

    Partitioned (``partition_cols``, a subset of ``keys``, e.g. ``year``): only
    the partitions the batch touches are read (partition pruning), merged and
    rewritten, with dynamic partition overwrite; Spark stages the new files and
    replaces just those partition folders at job commit. The cost is then
    proportional to the touched partitions, not the table. ``unchanged``
    counts rows of touched partitions only.

    A missing table is created from the batch (with ids / touch time).
    """
    partition_cols = list(partition_cols or [])
    if not set(partition_cols) <= set(keys):
        raise ValueError("partition columns must be part of the key")
    recover(spark, path)
    exists = table_exists(spark, path)
    if exists:
        target = spark.read.format(fmt).load(path)
    else:
        schema_cols = [F.col(c) for c in batch.columns if c != seq_col]
        empty = batch.select(*schema_cols).limit(0)
        if id_col and id_col not in empty.columns:
            empty = empty.withColumn(id_col, F.lit(None).cast("string"))
        if touch_col and touch_col not in empty.columns:
            empty = empty.withColumn(touch_col, F.lit(None).cast("timestamp"))
        target = empty
    if exists and partition_cols:
        # the touched partition values: bounded by the partitions one batch covers
        touched = [tuple(r) for r in batch.select(*partition_cols).distinct().collect()]
        cond = F.lit(False)
        for values in touched:
            match = F.lit(True)
            for c, v in zip(partition_cols, values):
                match = match & (F.col(c).isNull() if v is None else (F.col(c) == F.lit(v)))
            cond = cond | match
        target = target.filter(cond)
    merged = merge_upsert(target, batch, keys, set_cols, id_col, touch_col, seq_col, with_action=True)
    # counts are gathered by the write job itself (one pass over the data)
    obs = Observation("upsert")
    action = F.col(ACTION_COL)
    observed = merged.observe(
        obs,
        F.count_if(action == "insert").alias("inserted"),
        F.count_if(action == "update").alias("updated"),
        F.count_if(action == "keep").alias("unchanged"),
    ).drop(ACTION_COL)
    if partition_cols:
        # rebalance by the partition columns: each output partition gets few,
        # evenly sized files, and AQE splits a hot year instead of one task
        # writing it all
        writer = observed.hint("rebalance", *partition_cols).write.format(fmt).partitionBy(*partition_cols)
        if exists:
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)
        else:
            writer.mode("errorifexists").save(path)
    else:
        staging = f"{path.rstrip('/')}.staging-{_uuid.uuid4().hex}"
        observed.write.format(fmt).mode("overwrite").save(staging)
        _swap(spark, path, staging)
    return {k: int(v) for k, v in obs.get.items()}


def _swap(spark: SparkSession, path: str, new_path: str) -> None:
    fs, target = _hadoop_fs(spark, path)
    _, fresh = _hadoop_fs(spark, new_path)
    jvm = spark.sparkContext._jvm
    if fs.exists(target):
        backup = jvm.org.apache.hadoop.fs.Path(_backup(path))
        if not fs.rename(target, backup):
            raise OSError(f"could not move {path} aside")
        if not fs.rename(fresh, target):
            fs.rename(backup, target)
            raise OSError(f"could not move {new_path} into place")
        fs.delete(backup, True)
    elif not fs.rename(fresh, target):
        raise OSError(f"could not move {new_path} into place")
