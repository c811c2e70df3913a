import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from conftest import rows
from fieldlake.functions.keys import surrogate_key
from fieldlake.operators import dedup
from fieldlake.operators.aggregates import corr_leave_one_out, exact_percentiles, group_mode, share_of_parent
from fieldlake.operators.windows import series_features


def test_surrogate_key_matches_duckdb_md5(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "x")], "k long, s string, t string")
    got = rows(df.select("k", surrogate_key("k", "s", "t").alias("sk")))
    con = duckdb.connect()
    exp = con.sql("""SELECT k, md5(concat_ws('-', coalesce(CAST(k AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
                     coalesce(s, '_dbt_utils_surrogate_key_null_'), coalesce(t, '_dbt_utils_surrogate_key_null_')))
                     FROM (VALUES (1, 'a', NULL), (2, NULL, 'x')) v(k, s, t) ORDER BY k""").fetchall()
    assert got == [tuple(r) for r in exp]


def test_keep_first_last_and_null_order(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", None, "b"), ("k", 3, "c"), ("j", None, "z")],
                               "key string, t int, v string")
    first = rows(dedup.keep_first(df, "key", "t", tiebreak=["v"]), "key", "v")
    last = rows(dedup.keep_last(df, "key", "t", tiebreak=["v"]), "key", "v")
    assert first == [("j", "z"), ("k", "a")]          # NULL last on ASC
    assert last == [("j", "z"), ("k", "b")]           # NULL first on DESC (warehouse order)


def test_dominant_child_ties_and_nulls(spark):
    df = spark.createDataFrame([("p1", 1, 0.5), ("p1", 2, 0.5), ("p2", 1, None), ("p2", 2, 0.1), ("p3", 1, None)],
                               "parent string, cid int, w double")
    got = rows(dedup.dominant_child(df, "parent", "w", "cid"), "parent", "cid")
    assert got == [("p1", 1), ("p2", 2), ("p3", 1)]


def test_duplicate_report(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(dedup.duplicate_report(df, "k")) == [(1, 2)]


def _series(spark, hot_share=0.4, n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        ent = 0 if rnd.random() < hot_share else rnd.randint(1, 20)
        data.append((ent, i, i // 37, rnd.uniform(0, 100)))
    return spark.createDataFrame(data, "e int, t long, day long, v double")


def test_segmented_window_equals_plain_window(spark):
    df = _series(spark)
    plain = series_features(df, "e", ["t"], "v", before=3, after=3)
    seg = series_features(df, "e", ["t"], "v", before=3, after=3, segment=F.col("day"))
    cols = ["e", "t", "prev_value", "change", "rolling_mean"]
    a = [tuple(None if x is None else round(x, 9) for x in r) for r in rows(plain, *cols)]
    b = [tuple(None if x is None else round(x, 9) for x in r) for r in rows(seg, *cols)]
    assert a == b


def test_segmented_window_tiny_segments(spark):
    # segments smaller than the frame reach: edges must chain across several segments
    df = _series(spark, n=400).withColumn("day", F.col("t") % 3 + F.floor(F.col("t") / 3) * 3)
    df = df.withColumn("day", F.floor(F.col("t") / 2))
    plain = series_features(df, "e", ["t"], "v", before=3, after=3)
    seg = series_features(df, "e", ["t"], "v", before=3, after=3, segment=F.col("day"))
    cols = ["e", "t", "prev_value", "rolling_mean"]
    a = [tuple(None if x is None else round(x, 9) for x in r) for r in rows(plain, *cols)]
    b = [tuple(None if x is None else round(x, 9) for x in r) for r in rows(seg, *cols)]
    assert a == b


def test_exact_percentiles_match_numpy(spark, monkeypatch):
    import fieldlake.operators.aggregates as A

    def no_fallback(*a, **k):
        raise AssertionError("exact fallback used")
    monkeypatch.setattr(A.F, "percentile", no_fallback)
    rnd = np.random.default_rng(3)
    vals = [(int(g), float(v)) for g, v in zip(rnd.integers(0, 5, 5000), rnd.normal(size=5000).round(3))]
    vals += [(9, 1.0)] * 700 + [(9, 2.0)]  # heavy duplicates in one group
    df = spark.createDataFrame(vals, "g int, v double")
    got = {r["g"]: r for r in exact_percentiles(df, ["g"], "v", {"p10": 0.1, "med": 0.5, "p90": 0.9}, accuracy=100).collect()}
    for g in set(x[0] for x in vals):
        arr = np.array([v for gg, v in vals if gg == g])
        for name, p in (("p10", 0.1), ("med", 0.5), ("p90", 0.9)):
            assert abs(got[g][name] - np.quantile(arr, p)) < 1e-9


def test_group_mode_ties_to_smallest(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (1, None), (1, None), (1, None), (2, "z")],
                               "g int, v string")
    assert rows(group_mode(df, ["g"], "v", "m")) == [(1, "a"), (2, "z")]


def test_share_of_parent(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 3), ("b", "x", 2)], "p string, c string, n long")
    got = rows(share_of_parent(df, ["p"], "n", "pct"), "p", "c", "pct")
    assert got == [("a", "x", 25.0), ("a", "y", 75.0), ("b", "x", 100.0)]


def test_corr_leave_one_out(spark):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=12)
    y = 0.5 * x + rnd.normal(size=12)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "id int, x double, y double")
    got = {r["id"]: r["corr_without"] for r in corr_leave_one_out(df, "id", "x", "y").collect()}
    for i in range(12):
        m = np.ones(12, bool)
        m[i] = False
        assert abs(got[i] - np.corrcoef(x[m], y[m])[0, 1]) < 1e-9


def test_exact_percentiles_null_group_key_and_extras(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0), ("a", None), ("b", None)], "g string, v double")
    out = {r["g"]: r for r in exact_percentiles(df, ["g"], "v", {"med": 0.5},
                                                extra={"n": F.count(F.lit(1))}).collect()}
    assert out[None]["med"] == 2.0 and out[None]["n"] == 2
    assert out["a"]["med"] == 2.0 and out["a"]["n"] == 2
    assert out["b"]["med"] is None and out["b"]["n"] == 1


def test_exact_percentiles_refinement_pass(spark, monkeypatch):
    import fieldlake.operators.aggregates as A

    def no_fallback(*a, **k):
        raise AssertionError("exact fallback used: the refined bracket missed")
    monkeypatch.setattr(A.F, "percentile", no_fallback)
    rnd = np.random.default_rng(8)
    vals = [(int(g), float(v)) for g, v in zip(rnd.integers(0, 3, 20000), rnd.normal(size=20000).round(4))]
    vals += [(0, 0.5)] * 3000                                   # heavy duplicates in the hot group
    df = spark.createDataFrame(vals, "g int, v double")
    probs = {"p01": 0.01, "med": 0.5, "p999": 0.999}
    got = {r["g"]: r for r in exact_percentiles(df, ["g"], "v", probs, accuracy=100, max_candidates=50).collect()}
    for g in range(3):
        arr = np.array([v for gg, v in vals if gg == g])
        for name, p in probs.items():
            assert abs(got[g][name] - np.quantile(arr, p)) < 1e-9


def test_salted_join_equals_plain_join(spark):
    from fieldlake.operators.joins import salted_join
    big = spark.createDataFrame([(1 if i % 3 else i, i) for i in range(3000)], "k long, v long")   # key 1 is hot
    small = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (99999, "z")], "k long, tag string")
    for how in ("inner", "left"):
        assert rows(salted_join(big, small, "k", 16, how)) == rows(big.join(small, "k", how))


def test_exact_percentiles_never_deal_a_large_group_by_its_key(spark, monkeypatch):
    import fieldlake.operators.aggregates as A
    rnd = np.random.default_rng(5)
    vals = [(g, float(v)) for g, n in ((None, 900), (0, 2000), (1, 30), (2, 31)) for v in rnd.normal(size=n).round(3)]
    df = spark.createDataFrame(vals, "g int, v double")
    plans, meet = [], A._meet_brackets

    def seen(*a, **k):
        plans.append(meet(*a, **k)._jdf.queryExecution().executedPlan().toString())
        return meet(*a, **k)
    monkeypatch.setattr(A, "_meet_brackets", seen)
    # all brackets travel; only those of the large groups do; no group is large
    for few, hot, sent, dealt in ((10, 500, True, False), (0, 500, True, True), (0, 5000, False, True)):
        monkeypatch.setattr(A, "FEW_BRACKETS", few)
        monkeypatch.setattr(A, "HOT_ROWS", hot)
        got = {r["g"]: r["med"] for r in exact_percentiles(df, ["g"], "v", {"med": 0.5}, accuracy=100).collect()}
        assert set(got) == {None, 0, 1, 2}
        for g in got:
            assert abs(got[g] - np.quantile([v for gg, v in vals if gg == g], 0.5)) < 1e-9
        plan = plans[-1].split("Initial Plan")[-1]
        found = [line.lstrip(" +-:*") for line in plan.split("\n")]
        assert any(x.startswith("BroadcastHashJoin") and "LeftAnti" not in x for x in found) == sent
        assert any(x.startswith("Exchange hashpartitioning") for x in found) == dealt
        # what is dealt by group holds no row of a large one
        assert ("LeftAnti" in plan) == (sent and dealt)
