"""The library's operators applied to the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole tables; ``fieldlake.plans.oracle`` holds the equivalent DuckDB SQL.
Numeric outputs are doubles; averages and interpolated values are rounded
to a few digits on both sides so results compare exactly (N10).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..constants import DIAMETER_CLASSES, FIRE_SIZE_CLASSES, STAND_STAGES, STAND_STAGE_NULL
from ..functions.keys import surrogate_key
from ..functions.shape import (bin_at_least, bin_below, classify_contains, decode, safe_pct,
                               water_year)
from ..operators import dedup, joins
from ..operators.aggregates import (avg_when, count_when, exact_percentiles, group_mode, max_when)
from ..operators.windows import series_features
from ..plans.hydrology import water_year_summary as _wys
from .tables import read

R4 = 4


def fr(c, digits: int):
    """Round half up as ``floor(x * 10^d + 0.5) / 10^d``: plain IEEE arithmetic,
    so Spark and the SQL oracle produce the same double even on exact ties
    (``round`` differs between engines there, N10)."""
    col = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    return F.floor(col * scale + 0.5) / scale


def _region_of_customer(spark, sf) -> DataFrame:
    """customer -> region name; nation and region are fixed-size (broadcast)."""
    c = read(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = read(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    r = read(spark, sf, "region").select("r_regionkey", "r_name")
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
             .join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
             .select("c_custkey", F.col("r_name").alias("region")))


def region_daily_totals(spark, sf) -> DataFrame:
    """One reading per region-day: the daily order total (a flow series)."""
    o = read(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    cust = _region_of_customer(spark, sf)
    return (o.join(cust, o.o_custkey == cust.c_custkey)
             .groupBy("region", F.to_date("o_orderdate").alias("flow_date"))
             .agg(F.round(F.sum("o_totalprice"), 2).alias("discharge")))


# ---- flagship: M18 -> M19 on region flow ------------------------------------
def water_year_summary(spark: SparkSession, sf: str, min_days: int = 30) -> DataFrame:
    """Flashiness, percentiles and wettest-year rank per region and water year."""
    daily = series_features(region_daily_totals(spark, sf), "region", ["flow_date"], "discharge",
                            prev_alias="prev_discharge", change_alias="change_cfs",
                            rolling_alias=None)
    # the daily series (regions x days) is small and both percentile passes read
    # it: materialise it once instead of re-running the orders join
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    daily = daily.withColumn("water_year", water_year("flow_date")).checkpoint(eager=True)
    out = _wys(daily, ["region"], value="discharge", change="change_cfs", min_days=min_days,
               digits=None, flash_digits=None, volume_digits=0)
    return out.select("region", "water_year", "days_of_record",
                      *[fr(c, R4).alias(c) for c in ("mean_cfs", "min_cfs", "max_cfs", "median_cfs", "p10_cfs",
                                                      "p90_cfs")],
                      F.round("sum_abs_change", 2).alias("sum_abs_change"),
                      F.round("sum_discharge", 2).alias("sum_discharge"),
                      "annual_volume_af", fr("rb_flashiness_index", 6).alias("rb_flashiness_index"),
                      "wettest_year_rank")


# ---- K1-K7: keys and dedup ------------------------------------------------------
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_TIEBREAK = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                 "l_returnflag", "l_linestatus"]


def surrogate_key_dedup_first(spark, sf):
    """K1 + K2: earliest shipment per line key wins, ties broken on every column."""
    li = read(spark, sf, "lineitem")
    out = dedup.keep_first(li, LINE_KEY, "l_shipdate", tiebreak=LINE_TIEBREAK)
    return out.select(surrogate_key(*LINE_KEY).alias("line_sk"), *li.columns)


def surrogate_key_dedup_last(spark, sf):
    """K1 + K3: latest shipment wins (NULL first on DESC, as the warehouse)."""
    li = read(spark, sf, "lineitem")
    out = dedup.keep_last(li, LINE_KEY, "l_shipdate", tiebreak=LINE_TIEBREAK)
    return out.select(surrogate_key(*LINE_KEY).alias("line_sk"), *li.columns)


def keep_largest(spark, sf):
    """K4: largest line (by price) per order."""
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    out = dedup.keep_largest(li, "l_orderkey", "l_extendedprice", tiebreak=["l_linenumber", "l_partkey"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


def dominant_child(spark, sf):
    """K5: the line with the largest quantity per order (NULL last), ties by line number."""
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity")
    out = dedup.dominant_child(li, "l_orderkey", "l_quantity", ["l_linenumber", "l_suppkey", "l_partkey"])
    return out.select("l_orderkey", F.col("l_suppkey").alias("dominant_suppkey"), "l_quantity")


def latest_per_entity(spark, sf):
    """K6: newest order per customer."""
    o = read(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return dedup.latest_per_entity(o, "o_custkey", "o_orderdate", tiebreak=[F.col("o_orderkey").desc()])


def duplicate_report(spark, sf):
    """K7: line keys that occur more than once."""
    return dedup.duplicate_report(read(spark, sf, "lineitem"), LINE_KEY)


# ---- P6-P21: decode, bins, patterns, filters, flags --------------------------------
ORDER_STATUS = [("F", "Fulfilled"), ("O", "Open"), ("P", "Partial")]


def decode_status(spark, sf):
    """Code -> label with an else branch."""
    o = read(spark, sf, "orders")
    return (o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))
             .withColumn("status_label", decode("o_orderstatus", ORDER_STATUS, "Unknown")))


def threshold_bins(spark, sf):
    """P7 (value < bound): 5-unit classes on quantity, NULL to the else branch."""
    li = read(spark, sf, "lineitem")
    return (li.withColumn("quantity_class", bin_below("l_quantity", DIAMETER_CLASSES))
              .groupBy("quantity_class")
              .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("sum_qty")))


def size_class_bins(spark, sf):
    """P7 (value >= bound, largest first) on order totals."""
    o = read(spark, sf, "orders")
    return (o.withColumn("size_class", bin_at_least("o_totalprice", FIRE_SIZE_CLASSES))
              .groupBy("size_class").agg(F.count(F.lit(1)).alias("n_orders")))


def stage_bins(spark, sf):
    """P7 with a separate NULL label (stand-stage style) on part size."""
    p = read(spark, sf, "part")
    return (p.withColumn("stage", bin_below("p_size", STAND_STAGES, null_label=STAND_STAGE_NULL))
              .groupBy("stage").agg(F.count(F.lit(1)).alias("n_parts")))


PART_PATTERNS = [("RING", "Ring"), ("WIDGET", "Widget"), ("BOLT", "Bolt"), ("GEAR", "Gear")]


def pattern_class(spark, sf):
    """First matching case-insensitive substring, else 'Other'."""
    p = read(spark, sf, "part")
    return (p.withColumn("part_class", classify_contains("p_name", PART_PATTERNS, "Other"))
              .groupBy("part_class").agg(F.count(F.lit(1)).alias("n_parts")))


def range_filter(spark, sf):
    """P11 + P12: date range (pushed to the scan) and an IN list."""
    o = read(spark, sf, "orders")
    return (o.filter((F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
                     & (F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
                     & F.col("o_orderstatus").isin("F", "O"))
              .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"))


def like_filter(spark, sf):
    """P9 ILIKE / NOT ILIKE filter + P19 equality on a normalised name."""
    p = read(spark, sf, "part")
    return (p.filter(F.col("p_type").ilike("%o%") & ~F.col("p_type").ilike("%promo%"))
              .select("p_partkey", "p_name", "p_type",
                      (F.upper("p_name") == F.lit("SMALL RING")).alias("is_target")))


def flag_derive(spark, sf):
    """Flags from presence / comparison."""
    li = read(spark, sf, "lineitem")
    return (li.select(F.nullif("l_discount", F.lit(0.0)).isNotNull().alias("is_discounted"),
                      (F.col("l_returnflag") == "R").alias("is_returned"))
              .groupBy("is_discounted", "is_returned").agg(F.count(F.lit(1)).alias("n_lines")))


# ---- J1-J12: joins -------------------------------------------------------------
def _supplier_region(spark, sf):
    s = read(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    r = read(spark, sf, "region").select("r_regionkey", "r_name")
    return (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
             .join(F.broadcast(r), n.n_regionkey == r.r_regionkey))


def scoped_inner_join(spark, sf):
    """Only suppliers on the watch list (region ASIA) survive the inner join."""
    li = read(spark, sf, "lineitem").select("l_suppkey", "l_quantity")
    watch = _supplier_region(spark, sf).filter(F.col("r_name") == "ASIA").select("s_suppkey", "s_name")
    return (joins.scoped_join(li.withColumnRenamed("l_suppkey", "s_suppkey"), watch, "s_suppkey")
              .groupBy("s_suppkey", "s_name")
              .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("sum_qty")))


def left_lookup(spark, sf):
    """Lookup that keeps rows without a match (label NULL)."""
    li = read(spark, sf, "lineitem").select("l_partkey", "l_extendedprice")
    p = read(spark, sf, "part").filter(F.col("p_size") <= 40).select("p_partkey", "p_type")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return (joins.lookup(li.withColumnRenamed("l_partkey", "p_partkey"), p, "p_partkey")
              .groupBy("p_type").agg(F.count(F.lit(1)).alias("n_lines"),
                                     (F.sum(cents) / 100.0).alias("sum_price")))


def semi_join(spark, sf):
    """Parts that appear in a large line (EXISTS)."""
    p = read(spark, sf, "part").select("p_partkey", "p_name")
    big = read(spark, sf, "lineitem").filter(F.col("l_quantity") > 45).select("l_partkey")
    return joins.present_in(p, big, "p_partkey", "l_partkey")


def anti_join(spark, sf):
    """Orders with no returned line (NOT EXISTS)."""
    o = read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    ret = read(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R").select("l_orderkey")
    return joins.missing_from(o, ret, "o_orderkey", "l_orderkey")


def agg_join(spark, sf):
    """Join to an aggregated subquery (largest order and last order date)."""
    c = read(spark, sf, "customer").select("c_custkey", "c_name")
    o = (read(spark, sf, "orders").groupBy("o_custkey")
         .agg(F.max("o_totalprice").alias("max_price"), F.max("o_orderdate").alias("last_order")))
    return c.join(o, c.c_custkey == o.o_custkey, "inner").select("c_custkey", "c_name", "max_price", "last_order")


def coverage_join(spark, sf):
    """Every candidate nation reported, with order coverage over a window."""
    n = read(spark, sf, "nation").select("n_nationkey", "n_name")
    c = read(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    o = read(spark, sf, "orders").select("o_custkey", "o_orderdate")
    placed = o.join(c, o.o_custkey == c.c_custkey).select("n_nationkey", "o_orderdate")
    got = joins.coverage(n, placed, "n_nationkey", "o_orderdate", "1997-01-01", "1997-02-28")
    return got.select("n_nationkey", "n_name", F.col("n_obs").alias("n_orders"), F.col("first_obs").alias("first_order"),
                      F.col("last_obs").alias("last_order"))


# ---- A2-A9: conditional, pivot, expansion, shares --------------------------------
def conditional_agg(spark, sf):
    """A2 + A8: conditional counts, shares and averages without FILTER."""
    li = read(spark, sf, "lineitem")
    is_open = F.col("l_linestatus") == "O"
    return (li.groupBy("l_returnflag")
              .agg(F.count(F.lit(1)).alias("total_lines"), count_when(is_open).alias("open_lines"),
                   fr(avg_when(is_open, "l_quantity"), 4).alias("avg_open_qty"),
                   max_when(is_open, "l_discount").alias("max_open_discount"))
              .withColumn("pct_open", fr(safe_pct("open_lines", "total_lines"), 4)))


def pivot_pairs(spark, sf):
    """A3 + A22: before/after pivot by conditional max, both sides required."""
    li = read(spark, sf, "lineitem")
    pre, post = F.col("l_linestatus") == "F", F.col("l_linestatus") == "O"
    piv = li.groupBy("l_partkey").agg(max_when(pre, "l_quantity").alias("pre_qty"),
                                      max_when(post, "l_quantity").alias("post_qty"),
                                      max_when(pre, "l_extendedprice").alias("pre_price"),
                                      max_when(post, "l_extendedprice").alias("post_price"))
    return (piv.filter(F.col("pre_qty").isNotNull() & F.col("post_qty").isNotNull())
               .withColumn("qty_change", F.col("post_qty") - F.col("pre_qty"))
               .withColumn("pct_price_change", fr((F.col("post_price") - F.col("pre_price"))
                                                      / F.nullif(F.col("pre_price"), F.lit(0.0)) * 100, 4)))


def expansion_agg(spark, sf):
    """Per-unit measure times expansion factor, summed and scaled by 2000
    (exact in integer cents)."""
    li = read(spark, sf, "lineitem")
    wcents = F.round(F.col("l_extendedprice") * 100).cast("long") * F.col("l_quantity").cast("long")
    return (li.groupBy("l_returnflag")
              .agg((F.sum(F.when(F.col("l_linestatus") == "O", wcents)) / 200000.0).alias("open_expanded"),
                   (F.sum(F.when(F.col("l_linestatus") == "F", wcents)) / 200000.0).alias("closed_expanded")))


def share_having(spark, sf, min_lines: int = 550):
    """A8 + A9: returned share per supplier, thin groups dropped by HAVING."""
    li = read(spark, sf, "lineitem")
    return (li.groupBy("l_suppkey")
              .agg(F.count(F.lit(1)).alias("n_lines"),
                   count_when(F.col("l_returnflag") == "R").alias("returned_lines"))
              .filter(F.col("n_lines") >= min_lines)
              .withColumn("pct_returned", fr(safe_pct("returned_lines", "n_lines"), 4)))


def percentiles(spark, sf):
    """A4 + A5: exact median / p10 / p90 per user."""
    ev = read(spark, sf, "events")
    pct = exact_percentiles(ev, ["user_id"], "value", {"median_value": 0.5, "p10_value": 0.1, "p90_value": 0.9},
                            extra={"n_events": F.count(F.lit(1))})
    return pct.select(
        "user_id", "n_events", *[fr(c, 4).alias(c) for c in ("median_value", "p10_value", "p90_value")])


def mode_per_group(spark, sf):
    """Most common priority per customer, ties to the smallest value."""
    o = read(spark, sf, "orders")
    return group_mode(o, ["o_custkey"], "o_orderpriority", alias="mode_priority")


QUERIES = {
    "water_year_summary": water_year_summary,
    "surrogate_key_dedup_first": surrogate_key_dedup_first,
    "surrogate_key_dedup_last": surrogate_key_dedup_last,
    "keep_largest": keep_largest,
    "dominant_child": dominant_child,
    "latest_per_entity": latest_per_entity,
    "duplicate_report": duplicate_report,
    "decode_status": decode_status,
    "threshold_bins": threshold_bins,
    "size_class_bins": size_class_bins,
    "stage_bins": stage_bins,
    "pattern_class": pattern_class,
    "range_filter": range_filter,
    "like_filter": like_filter,
    "flag_derive": flag_derive,
    "scoped_inner_join": scoped_inner_join,
    "left_lookup": left_lookup,
    "semi_join": semi_join,
    "anti_join": anti_join,
    "agg_join": agg_join,
    "coverage_join": coverage_join,
    "conditional_agg": conditional_agg,
    "pivot_pairs": pivot_pairs,
    "expansion_agg": expansion_agg,
    "share_having": share_having,
    "percentiles": percentiles,
    "mode_per_group": mode_per_group,
}
