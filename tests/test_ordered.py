"""Stored order, and windows over pieces of a range sort."""

import os

from pyspark.sql import Window as W, functions as F

from fieldlake.operators.windows import RANGES, row_window, series_features
from fieldlake.sources import ordered


def test_positions_with_ties_nulls_and_no_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 != 0, F.col("id") % 7).alias("k"))
    ordered.write_ordered(df.repartition(5), path, "k", 6)
    rows = ordered.read_ordered(spark, path).orderBy("position").collect()
    assert [r.position for r in rows] == list(range(1, 1001))
    assert [r.k for r in rows] == sorted((r.k for r in rows), key=lambda v: (v is None, v))
    assert rows == ordered.read_ordered(spark, path).orderBy("position").collect()
    ordered.write_ordered(df.where("id < 0"), path, "k")
    assert ordered.read_ordered(spark, path).columns == ["id", "k", "position"] and ordered.read_ordered(spark, path).count() == 0


def hot(spark):
    """One entity holds most rows, all within one second; others have one to three rows."""
    many = spark.range(4000).select(F.lit(7).alias("e"), F.col("id").alias("t"), (F.col("id") * 37 % 101).cast("double").alias("v"))
    few = spark.range(300).select((F.col("id") % 130 + 8).cast("int").alias("e"), F.col("id").alias("t"), F.col("id").cast("double").alias("v"))
    odd = spark.createDataFrame([(None, 1, 1.0), (None, 2, None), (7, 10 ** 6, None)], "e int, t long, v double")
    return many.unionByName(few).unionByName(odd)


def test_range_segments_give_the_plain_window(spark):
    df = hot(spark)
    for reach in (1, 3, 40):
        f = lambda s: series_features(df, "e", "t", "v", before=reach, after=reach, segment=s)
        canon = lambda d: sorted(((r.e, r.t, r.v, r.prev_value, r.change, round(r.rolling_mean, 9) if r.rolling_mean is not None else None)
                                  for r in d.collect()), key=repr)
        assert canon(f(RANGES)) == canon(f(None))


def test_a_hot_entity_is_split_by_rows(spark):
    df = hot(spark)
    staged = ordered.stage_ordered(df, ["e", "t"], 16)
    share = staged.groupBy("e", ordered.part_of().alias("p")).count().agg(F.max("count")).first()[0]
    assert share <= 3 * df.count() / 16
    out = row_window(df, "e", "t", lambda w: {"n": F.lag("t", 2).over(w)}, 2, RANGES, 16)
    want = df.withColumn("n", F.lag("t", 2).over(W.partitionBy("e").orderBy("t")))
    assert out.columns == want.columns
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
