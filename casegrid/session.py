"""Spark session helpers.

Everything in the library is a lazy ``DataFrame -> DataFrame`` function; the
session only fixes the settings the operators rely on:

* ANSI mode stays on (bad casts raise unless a ``try_*`` form is used).
* AQE is on, with skew-join splitting and runtime broadcast conversion, so a
  join side is only broadcast after its real size has been measured.
* The session time zone is UTC so week/year extraction is stable.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF: dict[str, str] = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(total_cores: int, input_tb: float = 100.0) -> dict[str, str]:
    """Suggested settings for a large cluster (pass as ``extra_conf``).

    Shuffles start with enough partitions that no reducer receives more than
    a few hundred MB even for the largest exchange (the lineitem partial
    aggregate), and AQE coalesces them down to ~128 MB each at run time, so
    small stages do not pay for the large ones. Scans split files into 256 MB
    pieces; skewed partitions above 5x the median (and 512 MB) are split.
    """
    initial = max(total_cores * 4, int(input_tb * 1024 * 1024 / 256 / 8))  # ~256 MB per partition of a 1/8-size shuffle
    return {
        "spark.sql.shuffle.partitions": str(total_cores * 2),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }


def _master_configured() -> bool:
    """True when a master is already given (``spark-submit``, defaults file, env)."""
    if os.environ.get("SPARK_MASTER") or SparkSession.getActiveSession() is not None:
        return True
    from pyspark import SparkConf

    return SparkConf().contains("spark.master")


def get_spark(
    app_name: str = "casegrid",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    When a master is already configured (``spark-submit``, an active session)
    it is kept; only a plain ``python`` run defaults to ``local[cores]`` with
    one shuffle partition per core.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and not _master_configured():
        cpus = os.cpu_count() or 8
        master = f"local[{cpus}]"
        shuffle_partitions = shuffle_partitions or cpus
        builder = builder.config("spark.driver.memory", "8g")
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; if it is missing there, this fails rather than fall back to a
    machine-local folder. A scratch folder is only created for ``local[...]``
    masters (tests and local runs).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on the shared file system")
        configured = tempfile.mkdtemp(prefix="casegrid-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` once as Parquet under the checkpoint folder.

    A reliable ``checkpoint()`` without a prior persist computes its input
    twice (once for the action, once to write the checkpoint files); a written
    table is computed once, lives on the shared file system (so a lost executor
    only re-reads files) and is read back with column pruning and pushdown.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/casegrid-{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)
