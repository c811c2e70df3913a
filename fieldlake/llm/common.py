"""Reading tables and writing intermediate results for the operators here."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from fieldlake.session import shared_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def workers_find_this(spark: SparkSession) -> None:
    """Python workers started from another folder find this package too."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one table; other columns never enter the plan."""
    workers_find_this(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the folder that ``spark.checkpoint.dir``
    names and read it back: lineage ends there, and a lost executor costs no
    more than reading those files again.  Spark drops the shuffle files of
    the write as soon as it ends, so disks hold one step's at a time."""
    spark = df.sparkSession
    path = shared_path(spark, f"{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
