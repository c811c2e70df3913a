"""Plan-level guards for the scale properties the library relies on."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from fieldlake.functions import geo
from fieldlake.operators import dedup, spatial
from fieldlake.operators.aggregates import exact_percentiles, group_mode

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_before_the_shuffle(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    plan = _plan(dedup.keep_first(li, ["l_orderkey", "l_linenumber"], "l_shipdate"))
    # the partial limit sits below the exchange: hot duplicate keys shrink map-side
    partial = plan.find("Partial")
    exchange = plan.find("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan and partial > exchange >= 0


def test_skew_safe_aggregates_never_collect_a_group(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    for df in (exact_percentiles(ev, ["user_id"], "value", {"m": 0.5}, eager_check=False),
               group_mode(ev, ["user_id"], "event_type")):
        plan = _plan(df)
        assert not re.search(r"\bpercentile\(|collect_list|collect_set", plan), plan


def test_spatial_join_is_an_equi_join(spark):
    pts = spark.createDataFrame([(1, 0.5, 0.5)], "id int, x double, y double")
    pol = spark.createDataFrame([(7, "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))")], "pid int, w string") \
               .withColumn("geom", geo.parse_wkt("w"))
    plan = _plan(spatial.spatial_join(pts, pol, "x", "y", "geom"))
    assert "NestedLoopJoin" not in plan and "Cartesian" not in plan
    assert "HashJoin" in plan or "SortMergeJoin" in plan


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_registered_query_plan_has_no_all_pairs_or_python(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"
