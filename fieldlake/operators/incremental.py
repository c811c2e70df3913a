"""Idempotent upsert, late-data lookback, schema append, SCD2 history,
and partition-scoped writes of a merged table.

Parquet has no MERGE, so an upsert is ``target ⟕anti source ∪ source``.  At
scale the target is partitioned (e.g. by date) and only the partitions an
increment touches are read, merged and overwritten (dynamic partition
overwrite), staged through the shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import delete_path, shared_path, table_exists
from . import dedup
from .joins import attach_scalar


def _list(x) -> list:
    return [x] if isinstance(x, str) else list(x)


# ---- I2: lookback watermark ---------------------------------------------------------
def literal_of(value, dtype: str) -> Column:
    """A literal of ``dtype`` from a value collected on the driver.  A naive
    ``datetime`` from a timestamp_ntz column is passed as its ISO text, so no
    driver-local time zone is applied on the way back (F.lit(datetime) would
    interpret it in the driver's zone)."""
    import datetime as _dt
    if isinstance(value, _dt.datetime) and dtype == "timestamp_ntz":
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value).cast(dtype)


def watermark(target: DataFrame | None, ts_col: str, days: int):
    """``max(ts) - days`` of the target as a Python value (a single scalar), or
    None for a first run / full refresh / empty target (N4)."""
    if target is None:
        return None
    row = target.agg((F.max(ts_col) - F.make_dt_interval(F.lit(days))).alias("wm")).first()
    return row["wm"] if row else None


def lookback_filter(source: DataFrame, target: DataFrame | None, ts_col: str, days: int,
                    eager: bool = True) -> DataFrame:
    """Rows of ``source`` with ``ts > max(target.ts) - days``.

    ``eager`` turns the watermark into a literal first so the predicate reaches
    the Parquet scan (row-group skipping); otherwise a one-row scalar table is
    broadcast (its size is exactly one row)."""
    if target is None:
        return source
    dtype = source.schema[ts_col].dataType.simpleString()
    if eager:
        wm = watermark(target, ts_col, days)
        if wm is None:
            return source
        return source.filter(F.col(ts_col) > literal_of(wm, dtype))
    wm = target.agg((F.max(ts_col) - F.make_dt_interval(F.lit(days))).alias("_fl_wm"))
    return (attach_scalar(source, wm)
            .filter(F.col("_fl_wm").isNull() | (F.col(ts_col) > F.col("_fl_wm")))
            .drop("_fl_wm"))


# ---- I1 + I4: upsert ------------------------------------------------------------------
def merge_upsert(target: DataFrame | None, source: DataFrame, keys, order_col: str | None = None) -> DataFrame:
    """Matched keys take the source row, unmatched source rows are inserted,
    target rows without a source match stay.  New source columns are
    appended (old rows NULL).  ``order_col`` picks the latest source row when
    the increment repeats a key; idempotent: merging the same source twice
    gives the same table."""
    keys = _list(keys)
    if order_col is not None:
        source = dedup.keep_last(source, keys, order_col,
                                 tiebreak=[c for c in source.columns if c not in keys and c != order_col])
    if target is None:
        return source
    kept = target.join(source.select(*keys), on=keys, how="left_anti").select(*target.columns)
    return kept.unionByName(source, allowMissingColumns=True)


def incremental_model(target: DataFrame | None, staged: DataFrame, keys, loaded_col: str,
                      lookback_days: int, transform=None) -> DataFrame:
    """The incremental pattern: lookback filter on load time, optional
    transform of the increment, then upsert."""
    inc = lookback_filter(staged, target, loaded_col, lookback_days)
    if transform is not None:
        inc = transform(inc)
    return merge_upsert(target, inc, keys)


def read_stored(spark: SparkSession, path: str, like: DataFrame, partition_cols, fmt: str = "parquet") -> DataFrame:
    """A stored table with the types of ``like``: partition values are read as
    the source has them, never inferred ('00060' stays a string), columns that
    only ``like`` has are NULL, columns that only the table has stay."""
    stored = spark.read.format(fmt).load(path).schema
    fields = [like.schema[f.name] if f.name in like.columns and f.name in _list(partition_cols) else f for f in stored]
    fields += [f for f in like.schema if f.name not in stored.names]
    return spark.read.format(fmt).schema(T.StructType(fields)).load(path)


def merge_into_path(spark: SparkSession, path: str, source: DataFrame, keys,
                    partition_cols, fmt: str = "parquet") -> str:
    """I1 against a stored, partitioned table: only partitions present in
    ``source`` are merged and written, once, with dynamic partition overwrite:
    Spark writes beside the table and moves the partitions in when the job is
    done, so it may read what it replaces.  The increment alone is staged
    under the shared checkpoint folder, since it is read several times and
    must be the same each time.  The range of the touched partition values
    prunes the listing, a semi join keeps exactly them.  ``partition_cols``
    must be determined by the key; without any the merged table is staged and
    replaced.  A table that exists but cannot be read raises before anything
    is written."""
    keys, parts = _list(keys), _list(partition_cols)
    target, stage = None, shared_path(spark, "merge_stage", uuid.uuid4().hex)
    if table_exists(spark, path):
        source.write.format(fmt).save(stage + "/increment")
        source = spark.read.format(fmt).schema(source.schema).load(stage + "/increment")
        target = read_stored(spark, path, source, parts, fmt)
        if parts:
            touched = source.select(*parts).distinct()
            ends = touched.agg(*[f(c).alias(f"{n}_{c}") for c in parts for n, f in (("min", F.min), ("max", F.max))]).first()
            for c in parts:
                dtype = source.schema[c].dataType.simpleString()
                low, high = ends[f"min_{c}"], ends[f"max_{c}"]
                within = F.lit(False) if low is None else F.col(c).between(literal_of(low, dtype), literal_of(high, dtype))
                target = target.filter(within | F.col(c).isNull())
            t = touched.select(*[F.col(c).alias(f"_t_{c}") for c in parts])
            same = F.lit(True)
            for c in parts:
                same = same & F.col(c).eqNullSafe(F.col(f"_t_{c}"))
            target = target.join(t, same, "left_semi")
    merged = merge_upsert(target, source, keys)
    if target is not None and not parts:
        merged.write.format(fmt).save(stage + "/merged")
        merged = spark.read.format(fmt).schema(merged.schema).load(stage + "/merged")
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .format(fmt).partitionBy(*parts).save(path))
    delete_path(spark, stage)      # no longer needed once the write succeeded
    return path


# ---- I5: SCD2 check strategy --------------------------------------------------------------
def scd2_check(snapshot: DataFrame | None, current: DataFrame, key: str, check_cols,
               as_of: Column, invalidate_hard_deletes: bool = True,
               valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """One snapshot run: a change in any check column (NULL-safe) closes the
    open row at ``as_of`` and opens a new one; keys gone from ``current`` are
    closed when ``invalidate_hard_deletes``; new keys open a row; changes in
    other columns create no version.  Replaying the same ``current`` is a
    no-op."""
    check_cols = _list(check_cols)
    data_cols = [c for c in current.columns]
    if snapshot is None:
        return current.select(*data_cols, as_of.alias(valid_from),
                              F.lit(None).cast("timestamp_ntz").alias(valid_to))
    history = snapshot.filter(F.col(valid_to).isNotNull())
    open_ = snapshot.filter(F.col(valid_to).isNull())
    o = open_.select(*[F.col(c).alias(f"_o_{c}") for c in open_.columns])
    c = current.select(*[F.col(x).alias(f"_c_{x}") for x in data_cols])
    j = o.join(c, F.col(f"_o_{key}") == F.col(f"_c_{key}"), "full_outer")
    was, is_ = F.col(f"_o_{key}").isNotNull(), F.col(f"_c_{key}").isNotNull()
    changed = F.lit(False)
    for cc in check_cols:
        changed = changed | ~F.col(f"_o_{cc}").eqNullSafe(F.col(f"_c_{cc}"))
    closes = was & ((is_ & changed) | (~is_ if invalidate_hard_deletes else F.lit(False)))
    opens = is_ & (~was | changed)
    never = F.lit(None).cast("timestamp_ntz")
    # each joined pair yields its old row (open or closed now) and its new row, whichever it has
    old = F.struct(*[F.col(f"_o_{x}").alias(x) for x in data_cols], F.col(f"_o_{valid_from}").alias(valid_from),
                   F.when(closes, as_of).otherwise(F.col(f"_o_{valid_to}")).alias(valid_to))
    new = F.struct(*[F.col(f"_c_{x}").alias(x) for x in data_cols], as_of.alias(valid_from), never.alias(valid_to))
    versions = F.array_compact(F.array(F.when(was, old), F.when(opens, new)))
    return history.unionByName(j.select(F.inline(versions)))


# ---- I7: targeted reload --------------------------------------------------------------------
def batch_slice(df: DataFrame, batch_col: str, batch_ids) -> DataFrame:
    return df.filter(F.col(batch_col).isin(*_list(batch_ids)))
