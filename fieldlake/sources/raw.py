"""Raw semi-structured landing (bronze)."""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def batch_id(now: _dt.datetime | None = None) -> str:
    """Run tracing id = UTC date + 8 hex."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return f"{now:%Y%m%d}_{uuid.uuid4().hex[:8]}"


def read_raw_json(spark: SparkSession, path: str, batch: str, loaded_at: Column | str | None = None,
                  strict: bool = True) -> DataFrame:
    """One JSON object per line (gzip read transparently) ->
    ``(payload variant, _loaded_at timestamp_ntz, _batch_id string)``.

    ``strict``: a malformed line aborts the load (MALFORMED_RECORD_IN_PARSING).
    Otherwise malformed lines get a NULL payload and the raw text is kept in
    ``_raw`` for quarantine (see :func:`quarantine`)."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    ts = (F.current_timestamp().cast("timestamp_ntz") if loaded_at is None else
          (F.lit(loaded_at).cast("timestamp_ntz") if isinstance(loaded_at, str) else loaded_at))
    if strict:
        return lines.select(F.parse_json("value").alias("payload"), ts.alias("_loaded_at"),
                            F.lit(batch).alias("_batch_id"))
    return lines.select(F.try_parse_json("value").alias("payload"), ts.alias("_loaded_at"),
                        F.lit(batch).alias("_batch_id"), F.col("value").alias("_raw"))


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a non-strict load into (good rows, bad rows)."""
    good = df.filter(F.col("payload").isNotNull()).drop("_raw")
    bad = df.filter(F.col("payload").isNull())
    return good, bad


def append_bronze(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Create-if-missing, append, never mutate."""
    df.write.mode("append").format(fmt).save(path)


def replace_bronze(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """S3: create or replace a static bronze table."""
    df.write.mode("overwrite").format(fmt).save(path)


def write_ndjson(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Gzip NDJSON; non-JSON values (dates, timestamps) become strings."""
    df.write.mode(mode).option("compression", "gzip").json(path)
