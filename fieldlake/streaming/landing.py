"""I8: NDJSON files arriving in a landing folder -> typed, deduplicated rows.

Two forms:
* ``stream_first_wins``: watermark + ``dropDuplicatesWithinWatermark`` --
  bounded state, first arrival of a key wins (like the staging dedup).
* ``stream_upsert``: ``foreachBatch`` that keeps the latest row per key in
  each micro-batch and merges it into a partitioned table (revisions win).

The event-time column used for the watermark must be TIMESTAMP (LTZ);
timestamp_ntz is rejected by Spark, so it is cast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators import dedup, incremental


def read_landing(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).option("mode", "FAILFAST")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.json(path)


def stream_first_wins(stream: DataFrame, keys, event_time: str, delay: str = "7 days") -> DataFrame:
    """Watermarked dedup: state for a key is dropped once the watermark passes."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    s = stream.withColumn("_event_ts", F.col(event_time).cast("timestamp"))
    return s.withWatermark("_event_ts", delay).dropDuplicatesWithinWatermark(keys)


def stream_upsert(stream: DataFrame, target_path: str, keys, order_col: str, partition_cols,
                  checkpoint: str, trigger_available_now: bool = True):
    """Each micro-batch: latest row per key, then partition-scoped merge into
    ``target_path``.  Idempotent per batch, so a replayed batch after a
    failure rewrites the same partitions with the same rows."""
    keys = [keys] if isinstance(keys, str) else list(keys)

    def _apply(batch: DataFrame, epoch_id: int):
        latest = dedup.keep_last(batch, keys, order_col,
                                 tiebreak=[c for c in batch.columns if c not in keys and c != order_col])
        incremental.merge_into_path(batch.sparkSession, target_path, latest, keys, partition_cols)

    w = stream.writeStream.foreachBatch(_apply).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_available_now else w.trigger(processingTime="1 minute")
    return w.start()
