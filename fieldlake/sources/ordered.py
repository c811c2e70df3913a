"""Results whose order is stored with them.

A global sort is one range shuffle; the position of each row then needs no
window over all rows: a row's place inside its partition is known where it is
written, and the partitions' sizes (one number each) give the rest."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..session import shared_path

#: column of a stored, ordered table: partition number, then 33 bits of the row's place in it
PLACE = "_place"
_BITS = 33


def _keys(order) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in ([order] if isinstance(order, (str, Column)) else order)]


def write_ordered(df: DataFrame, path: str, order, n_parts: int | None = None, mode: str = "overwrite") -> None:
    """Range-partition and sort ``df`` by ``order`` (names, ascending with
    nulls last, or sort expressions) and store each row with its place.
    Without ``n_parts`` the number of partitions follows the data's size (AQE).
    Equal keys stay in one partition, in any but from then on fixed order."""
    keys = _keys(order)
    out = df.repartitionByRange(n_parts, *keys) if n_parts else df.repartitionByRange(*keys)
    out.sortWithinPartitions(*keys).withColumn(PLACE, F.monotonically_increasing_id()).write.mode(mode).parquet(path)


def part_of(place: str = PLACE) -> Column:
    """Number of the range partition a stored row belongs to."""
    return F.shiftright(F.col(place), _BITS)


def read_ordered(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """The stored rows with ``position`` (from 1).  The partitions' offsets,
    one row each, are broadcast."""
    df = spark.read.parquet(path)
    sizes = df.groupBy(part_of().alias("_fl_part")).agg(F.count(F.lit(1)).alias("_fl_n"))
    # one row a partition: as many as the write had tasks
    before = F.coalesce(F.sum("_fl_n").over(W.orderBy("_fl_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_fl_part", before.alias("_fl_before"))
    placed = df.join(F.broadcast(offsets), part_of() == F.col("_fl_part"))
    inside = F.col(PLACE).bitwiseAND(F.lit((1 << _BITS) - 1))
    return placed.withColumn(position, F.col("_fl_before") + inside + 1).drop("_fl_part", "_fl_before", PLACE)


def stage_ordered(df: DataFrame, order, n_parts: int | None = None) -> DataFrame:
    """``df`` range-sorted in the shared folder and read again, with its places."""
    path = shared_path(df.sparkSession, f"ordered-{uuid.uuid4().hex}")
    write_ordered(df, path, order, n_parts)
    return df.sparkSession.read.parquet(path)
