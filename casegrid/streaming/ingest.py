"""Incremental case-file ingest with Structured Streaming.

The surveillance source's only late-data mechanism is re-running the keyed
upsert when a corrected week arrives. Here that becomes a file-source stream:
every new ``{year}_{Disease}.csv`` dropped into a folder is parsed, keyed and
upserted into the historical table in ``foreachBatch``. The upsert is
idempotent, so a micro-batch replayed after a failure (same epoch, same files)
leaves the same table: the effect is exactly-once. Progress is tracked in the
stream's checkpoint location, which must be on the shared file system.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from casegrid.dims import Dims, surveillance_dims
from casegrid.operators import loads, upsert
from casegrid.sources.files import CASE_COLUMNS, _string_schema, name_part

LOG = logging.getLogger("casegrid.ingest")


def case_file_stream(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming raw case rows (as ``read_case_files``, with ``_time``, ``_file``
    and ``_block`` instead of ``_row_seq``: the in-split position is added per
    micro-batch, where the batch is a plain file scan).

    A streaming file source needs a fixed schema, so dropped files must have
    the standard column order ``week_number, area_reported, cases_reported``;
    another header fails the batch rather than being read wrongly.

    ``directory`` may be a glob. Drops that ``sinks.write_case_files`` wrote (a
    folder for each year and disease) under ``<base>/<drop>`` are read by
    ``<base>/*/*.csv``.
    """
    reader = spark.readStream.schema(_string_schema(CASE_COLUMNS)).option("header", True).option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.option("pathGlobFilter", "*.csv").csv(directory)
    return raw.select(
        name_part(1).try_cast("int").alias("year"),
        name_part(2).alias("disease"),
        "week_number",
        "area_reported",
        "cases_reported",
        F.col("_metadata.file_modification_time").alias("_time"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def start_historical_ingest(
    spark: SparkSession,
    directory: str,
    table: str,
    checkpoint_location: str,
    dims: Dims | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    on_batch: Callable[[int, dict], None] | None = None,
) -> StreamingQuery:
    """Start the ingest; each micro-batch is upserted into ``table`` (Parquet).

    ``available_now`` processes everything present and stops (scheduled runs);
    pass ``processing_time`` (e.g. ``"1 minute"``) for a continuously running job.
    ``max_files_per_trigger`` bounds each micro-batch, so a large backlog is
    worked through in steps of known size (``availableNow`` honours it too).
    ``on_batch(epoch, counts)`` gets each micro-batch's rows, those of files with
    an unknown name, those with an unknown district or disease, and what the
    upsert did; without it they are logged.
    """
    dims = dims or surveillance_dims(spark)

    def upsert_batch(batch: DataFrame, epoch_id: int) -> None:
        # the newest file is the last correction, whatever its name
        seq = F.struct(F.col("_time"), F.col("_file"), F.col("_block"), F.monotonically_increasing_id())
        batch = batch.withColumn("_row_seq", seq).drop("_time", "_file", "_block")
        # read three times (counts, touched years, merge): kept while the batch is worked on
        batch = batch.persist()
        try:
            read = batch.agg(F.count(F.lit(1)).alias("rows"),
                             F.count_if(F.col("year").isNull()).alias("rows_of_misnamed_files")).first()
            rows = loads.keyed_case_rows(batch, dims)
            skipped = loads.load_report(rows, by=None).select("skipped_unknown_district", "skipped_unknown_disease").first()
            done = upsert.upsert_table(
                batch.sparkSession, table, loads.accepted(rows).drop("disease"), loads.HISTORICAL_KEYS, ["case_count"],
                id_col="data_id", seq_col="_row_seq", partition_cols=["year"],
            )
        finally:
            batch.unpersist()
        counts = {**read.asDict(), **skipped.asDict(), **done}
        if on_batch:
            on_batch(epoch_id, counts)
        else:
            lost = any(v for k, v in counts.items() if k.startswith(("skipped", "rows_of")))
            LOG.log(logging.WARNING if lost else logging.INFO, "micro-batch %s: %s", epoch_id, counts)

    writer = (
        case_file_stream(spark, directory, max_files_per_trigger)
        .writeStream.foreachBatch(upsert_batch)
        .option("checkpointLocation", checkpoint_location)
    )
    if processing_time:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
