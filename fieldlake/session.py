"""Spark session defaults and shared-storage helpers."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every fieldlake job relies on.  AQE re-plans joins from runtime
# sizes, coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of DataFrames that went out of scope are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def sizing(input_bytes: int, executors: int, cores_per_executor: int, executor_memory_gb: float,
           target_partition_mb: int = 200, max_scan_split_mb: int = 512) -> dict:
    """Spark settings that keep every task's share of data within executor
    memory at the target scale.

    * shuffle partitions ~ input / target partition size, at least 2x the
      cores, rounded up to a multiple of the cores; AQE coalesces small ones
      and splits skewed ones (the advisory size is the target size);
    * scan splits bounded by the memory one task may use (a quarter of the
      executor's memory divided among its cores) and by ``max_scan_split_mb``.
    """
    cores = max(1, executors * cores_per_executor)
    per_task_mb = executor_memory_gb * 1024 / max(1, cores_per_executor)
    target_mb = max(32, min(target_partition_mb, int(per_task_mb / 4)))
    parts = max(2 * cores, -(-int(input_bytes) // (target_mb * 1024 * 1024)))
    parts = -(-parts // cores) * cores
    split_mb = max(32, min(max_scan_split_mb, int(per_task_mb / 4)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * target_mb}m",
        "spark.sql.files.maxPartitionBytes": f"{split_mb}m",
    }


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "fieldlake", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with fieldlake defaults.

    On a cluster the master and partition counts come from the submit
    configuration; ``master``/``shuffle_partitions`` are for local runs.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``; set one only where the session has none.

    Without a configured folder: use ``fallback`` if given (tests, bench);
    on a ``local`` master use a fresh scratch folder; on a cluster raise --
    a machine-local folder would not survive the loss of an executor."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if fallback is None and sc.master.startswith("local"):
            import tempfile
            fallback = tempfile.mkdtemp(prefix="fieldlake-ckpt-")
        if fallback is None:
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS/S3/...) "
                               "for checkpoints and staged merges")
        configured = fallback
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder, for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), *parts) if "://" not in base else "/".join([base.rstrip("/"), *parts])


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursively delete a (shared-storage) path through the Hadoop FS API."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a stored table lies at ``path``: the folder has an entry that is
    not hidden.  Any failure to look (permissions, network) is raised."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return False
    return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(p))
