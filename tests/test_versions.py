"""Tables that become current together; a merge writes its data once."""

import os

import pytest

from fieldlake.operators import incremental
from fieldlake.plans import build, checks
from fieldlake.sources import versions


def put(spark, root, value, names=("a", "b")):
    base, before = versions.head(spark, root)
    folder = versions.new_folder(root)
    for n in names:
        spark.createDataFrame([(n, value)], "name string, value int").write.parquet(os.path.join(folder, n))
    return base, before | {n: os.path.join(folder, n) for n in names}


def values(spark, root):
    return {n: versions.read_table(spark, root, n).first().value for n in versions.head(spark, root)[1]}


def test_commits_switch_all_tables_and_losers_fail(spark, tmp_dir):
    root = os.path.join(tmp_dir, "out")
    assert versions.head(spark, root) == (0, {}) and versions.table_path(spark, root, "a") is None
    with pytest.raises(LookupError):
        versions.read_table(spark, root, "a")
    versions.commit(spark, root, *put(spark, root, 1))
    mine, other = put(spark, root, 2), put(spark, root, 3, ["b"])
    assert values(spark, root) == {"a": 1, "b": 1}            # written, not committed
    versions.commit(spark, root, *mine)
    assert values(spark, root) == {"a": 2, "b": 2}
    with pytest.raises(RuntimeError):
        versions.commit(spark, root, *other)
    assert values(spark, root) == {"a": 2, "b": 2}
    with open(os.path.join(root, "_commits", "000000000003.json"), "w") as f:
        f.write('{"tables": {"a"')                             # its writer died
    assert values(spark, root) == {"a": 2, "b": 2}
    versions.commit(spark, root, *put(spark, root, 4, ["b"]))
    assert values(spark, root) == {"a": 2, "b": 4}
    gone = versions.remove_old(spark, root, keep=1)
    assert len(gone) == 2 and values(spark, root) == {"a": 2, "b": 4}


def test_a_build_killed_between_tables_leaves_the_last_one(spark, tmp_dir, monkeypatch):
    out = os.path.join(tmp_dir, "silver")
    tables = lambda v: {n: spark.createDataFrame([(v,)], "value int") for n in ("dim_lakes", "dim_gages")}
    monkeypatch.setattr(checks, "suite", lambda models: sorted(models))
    state = {"v": 1}
    monkeypatch.setattr(build, "build_models", lambda *a, **k: tables(state["v"]))
    assert build.build(spark, {}, {}, out) == ["dim_gages", "dim_lakes"]
    plain, state["v"] = build.write_models, 2

    def dies(models, root, names=None):
        plain(models, root, names[:1])
        raise OSError("killed")

    monkeypatch.setattr(build, "write_models", dies)
    with pytest.raises(OSError):
        build.build(spark, {}, {}, out)
    assert values(spark, out) == {"dim_lakes": 1, "dim_gages": 1}
    monkeypatch.setattr(build, "write_models", plain)
    build.build(spark, {}, {}, out)
    assert values(spark, out) == {"dim_lakes": 2, "dim_gages": 2}


def test_a_merge_reads_its_source_once_and_writes_once(spark, tmp_dir):
    from pyspark.sql import functions as F
    path = os.path.join(tmp_dir, "t")
    base = spark.range(100).select("id", (F.col("id") % 4).alias("d"), F.lit(0.0).alias("v"))
    incremental.merge_into_path(spark, path, base, "id", "d")
    untouched = sorted(os.listdir(os.path.join(path, "d=3")))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    new = spark.range(10).select("id", (F.col("id") % 2).alias("d"), F.rand().alias("v")).mapInPandas(count, "id long, d long, v double")
    new = new.withColumn("d", F.col("id") % 4).where("id % 4 < 2")
    incremental.merge_into_path(spark, path, new, "id", "d")
    assert seen.value == 10                                     # one evaluation, so a random source is one source
    assert spark.read.parquet(path).count() == 100 and spark.read.parquet(path).where("v > 0").count() == 6
    assert sorted(os.listdir(os.path.join(path, "d=3"))) == untouched
    flat = os.path.join(tmp_dir, "flat")
    for _ in range(2):
        incremental.merge_into_path(spark, flat, base.drop("d"), "id", [])
    assert spark.read.parquet(flat).count() == 100
