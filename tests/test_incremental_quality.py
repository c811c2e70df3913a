import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from fieldlake.operators import incremental, quality


def _tgt(spark):
    return spark.createDataFrame([(1, "a", "2024-01-01 00:00:00"), (2, "b", "2024-01-05 00:00:00")],
                                 "k int, v string, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def test_merge_upsert_idempotent_and_appends_columns(spark):
    tgt = _tgt(spark)
    src = spark.createDataFrame([(2, "B", "2024-01-06 00:00:00", 1), (3, "c", "2024-01-06 00:00:00", 1)],
                                "k int, v string, ts string, rev int").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    once = incremental.merge_upsert(tgt, src, "k")
    twice = incremental.merge_upsert(once, src, "k")
    assert rows(once, "k", "v", "rev") == [(1, "a", None), (2, "B", 1), (3, "c", 1)]
    assert rows(once) == rows(twice.select(*once.columns))


def test_lookback_filter_and_empty_target(spark):
    tgt = _tgt(spark)
    src = spark.createDataFrame([(9, "x", "2024-01-01 12:00:00"), (8, "y", "2024-01-03 00:00:01")],
                                "k int, v string, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = rows(incremental.lookback_filter(src, tgt, "ts", 2), "k")
    assert got == [(8,)]                      # > 2024-01-05 - 2 days
    lazy = rows(incremental.lookback_filter(src, tgt, "ts", 2, eager=False), "k")
    assert lazy == got
    empty = tgt.filter("false")
    assert len(rows(incremental.lookback_filter(src, empty, "ts", 2))) == 2   # N4: no filter
    assert len(rows(incremental.lookback_filter(src, None, "ts", 2))) == 2    # I3 full refresh


def test_scd2_cases(spark):
    cur1 = spark.createDataFrame([("s1", "A", 1.0, "o1"), ("s2", "B", 2.0, "o1"), ("s3", "C", 3.0, "o1"),
                                  ("s4", "D", 4.0, "o1")], "id string, name string, lat double, org string")
    t1, t2 = F.lit("2024-01-01").cast("timestamp_ntz"), F.lit("2024-02-01").cast("timestamp_ntz")
    snap = incremental.scd2_check(None, cur1, "id", ["name", "lat"], t1)
    cur2 = spark.createDataFrame([("s1", "A", 1.0, "o1"), ("s2", "B2", 2.0, "o1"), ("s3", "C", 3.0, "o2"),
                                  ("s5", "E", 5.0, "o1")], "id string, name string, lat double, org string")
    snap2 = incremental.scd2_check(snap, cur2, "id", ["name", "lat"], t2)
    got = rows(snap2.select("id", "name", F.col("valid_to").isNull().alias("open")))
    assert got == [("s1", "A", True), ("s2", "B", False), ("s2", "B2", True), ("s3", "C", True),
                   ("s4", "D", False), ("s5", "E", True)]
    replay = incremental.scd2_check(snap2, cur2, "id", ["name", "lat"], F.lit("2024-03-01").cast("timestamp_ntz"))
    assert rows(replay) == rows(snap2.select(*replay.columns))   # replay is a no-op


def test_merge_into_path_rewrites_only_touched_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "tbl")
    base = spark.createDataFrame([(1, "2024-01-01", "a"), (2, "2024-01-02", "b")], "k int, d string, v string")
    incremental.merge_into_path(spark, path, base, "k", "d")
    upd = spark.createDataFrame([(2, "2024-01-02", "B"), (3, "2024-01-03", "c")], "k int, d string, v string")
    incremental.merge_into_path(spark, path, upd, "k", "d")
    incremental.merge_into_path(spark, path, upd, "k", "d")   # idempotent
    assert rows(spark.read.parquet(path), "k", "v") == [(1, "a"), (2, "B"), (3, "c")]


def test_merge_into_path_keeps_types_and_null_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "typed")
    base = spark.createDataFrame([(1, "00060", "2024-01-01", "a"), (2, "00060", "2024-01-01", "b"), (3, None, "2024-01-01", "n"),
                                  (4, "00065", "2024-01-02", "x")], "k int, code string, d string, v string")
    incremental.merge_into_path(spark, path, base, "k", ["code", "d"])
    upd = spark.createDataFrame([(2, "00060", "2024-01-01", "B", 7), (5, None, "2024-01-01", "m", 8)],
                                "k int, code string, d string, v string, extra int")
    for _ in range(2):                        # a replayed batch changes nothing
        incremental.merge_into_path(spark, path, upd, "k", ["code", "d"])
    got = incremental.read_stored(spark, path, upd, ["code", "d"])
    assert dict(got.dtypes)["code"] == "string" and dict(got.dtypes)["d"] == "string"
    assert rows(got, "k", "v", "extra") == [(1, "a", None), (2, "B", 7), (3, "n", None), (4, "x", None), (5, "m", 8)]
    assert {(r.k, r.code) for r in got.collect()} == {(1, "00060"), (2, "00060"), (3, None), (4, "00065"), (5, None)}
    incremental.merge_into_path(spark, path, upd.limit(0), "k", ["code", "d"])
    assert incremental.read_stored(spark, path, upd, ["code", "d"]).count() == 5


def test_merge_into_path_writes_nothing_when_the_target_cannot_be_read(spark, tmp_dir):
    path = os.path.join(tmp_dir, "broken")
    incremental.merge_into_path(spark, path, spark.createDataFrame([(1, "p", "a"), (2, "q", "b")], "k int, d string, v string"), "k", "d")
    part = os.path.join(path, "d=p")
    for f in os.listdir(part):
        if f.endswith(".parquet"):
            with open(os.path.join(part, f), "wb") as out:
                out.write(b"not a parquet file")
    before = sorted((root, f) for root, _, files in os.walk(path) for f in files)
    with pytest.raises(Exception):
        incremental.merge_into_path(spark, path, spark.createDataFrame([(3, "p", "c")], "k int, d string, v string"), "k", "d")
    assert sorted((root, f) for root, _, files in os.walk(path) for f in files) == before


def test_quality_report_single_pass_and_failing_rows(spark):
    df = spark.createDataFrame([(1, "A", 0.5, 1), (1, "X", 2.0, 9), (None, None, None, 2)],
                               "k int, flag string, pct double, parent int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    checks = [quality.not_null("k"), quality.unique("k"), quality.accepted_values("flag", ["A"], "warn"),
              quality.accepted_range("pct", 0, 1), quality.relationships("parent", parent, "id"),
              quality.expression("pct_not_two", F.col("pct") == 2.0)]
    rep = {r["check_name"]: (r["failing_rows"], r["status"]) for r in quality.run_checks(df, checks).collect()}
    assert rep == {"not_null_k": (1, "fail"), "unique_k": (1, "fail"), "accepted_values_flag": (1, "warn"),
                   "accepted_range_pct": (1, "fail"), "relationships_parent": (1, "fail"),
                   "pct_not_two": (1, "fail")}
    assert quality.failing_rows(df, checks[4]).count() == 1


def test_freshness(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    st = lambda now: quality.freshness(df, "t", now, 4, 8).first()["status"]
    assert st("2024-01-03 00:00:00") == "pass"
    assert st("2024-01-06 00:00:00") == "warn"
    assert st("2024-01-10 00:00:00") == "error"


def test_watermark_literal_ignores_driver_time_zone(spark):
    import datetime as dt
    import os
    import time as _time
    old = os.environ.get("TZ")
    os.environ["TZ"] = "America/Los_Angeles"
    _time.tzset()
    try:
        lit = incremental.literal_of(dt.datetime(2024, 1, 5, 12, 0, 0), "timestamp_ntz")
        got = spark.range(1).select(lit.cast("string").alias("s")).first()["s"]
        assert got == "2024-01-05 12:00:00"
    finally:
        if old is None:
            os.environ.pop("TZ", None)
        else:
            os.environ["TZ"] = old
        _time.tzset()


def test_sizing_for_100tb():
    from fieldlake.session import sizing
    conf = sizing(100 * 1024 ** 4, executors=1000, cores_per_executor=8, executor_memory_gb=32)
    parts = int(conf["spark.sql.shuffle.partitions"])
    assert parts % 8000 == 0 and 100 * 1024 ** 4 / parts <= 200 * 1024 ** 2   # <= 200 MB per shuffle partition
    assert conf["spark.sql.files.maxPartitionBytes"] == "512m"
    small = sizing(10 * 1024 ** 2, executors=1, cores_per_executor=8, executor_memory_gb=4)
    assert small["spark.sql.shuffle.partitions"] == "16" and small["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "128m"
