"""Driver-table queries, part 2: series windows, analyses, pairing,
incremental merge, history, quality and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.shape import (clean_name, decade, safe_pct, strip_float_suffix, timing_label,
                               variant_field, try_variant_field, water_year, pct_change)
from ..operators import incremental, quality
from ..operators.aggregates import corr_leave_one_out as corr_leave_one_out_op
from ..operators.aggregates import (count_when, exact_percentiles, max_when,
                                    profile, ratio_summary, record_length, share_of_parent)
from ..operators.windows import series_features
from . import analyses
from .mapped import fr, region_daily_totals
from .tables import read

LOCAL_TZ = "America/Los_Angeles"


def _day(c="ts"):
    """Series segment for event streams: the hour.  Any column monotone in
    the order gives the same result; finer segments spread a hot user over
    more tasks (at 100 TB one user-day can still be far too big for a task)."""
    return F.date_trunc("hour", F.col(c))


def _event_series(spark, sf, rolling=False) -> DataFrame:
    ev = read(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    return series_features(ev, "user_id", ["ts", "event_id"], "value", prev_alias="prev_value",
                           change_alias="change", rolling_alias="rolling_mean" if rolling else None,
                           segment=_day())


# ---- P1-P4: variant extraction ------------------------------------------------
def variant_project(spark, sf):
    """P1 + P3 + P10: parse JSON props, typed and safe extraction, drop rows without the key."""
    ev = read(spark, sf, "events").select("event_id", "event_type", F.parse_json("props").alias("payload"))
    return (ev.select("event_id", "event_type", variant_field("payload", "k", "int").alias("k"),
                      try_variant_field("payload", "k", "double").alias("k_double"))
              .filter(F.col("k").isNotNull()))


# ---- W1-W9 ------------------------------------------------------------------------
def lag_change_rolling(spark, sf):
    """W1-W3 per user: previous value, change, centred 7-row mean (segmented by day)."""
    s = _event_series(spark, sf, rolling=True)
    return s.select("user_id", "event_id", "ts", "value", "prev_value", "change",
                    fr("rolling_mean", 6).alias("rolling_mean"))


def daily_flow_features(spark, sf):
    """M18 core on the region flow series (segmented by year)."""
    daily = region_daily_totals(spark, sf)
    out = series_features(daily, "region", ["flow_date"], "discharge", prev_alias="prev_discharge",
                          change_alias="change_cfs", rolling_alias="rolling_7d_mean",
                          segment=F.year("flow_date"))
    return out.select("region", "flow_date", "discharge", "prev_discharge", "change_cfs",
                      fr("rolling_7d_mean", 6).alias("rolling_7d_mean"),
                      water_year("flow_date").alias("water_year"))


def share_of_group(spark, sf):
    """Count share within the parent group."""
    li = read(spark, sf, "lineitem")
    counted = li.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    out = share_of_parent(counted, ["l_returnflag"], "n", "pct_of_flag")
    return out.withColumn("pct_of_flag", fr("pct_of_flag", 4))


def top_jumps(spark, sf, k: int = 20):
    """K largest single-step changes per user series."""
    ev = read(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    out = analyses.jumps(ev, "user_id", "ts", "value", k, segment=_day(), order=["ts", "event_id"],
                         tiebreak=["event_id"])
    return out.select("user_id", "event_id", "ts", "value", "prev_value", "change", "abs_change")


def jump_by_weekday(spark, sf, threshold: float = 300.0):
    """D3: count of large jumps by weekday."""
    ev = read(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    return analyses.jumps_by_weekday(ev, "user_id", "ts", "value", threshold, segment=_day(),
                                     order=["ts", "event_id"])


def diurnal_profile(spark, sf):
    """Mean by local hour and the daily amplitude as ± % of the mean."""
    ev = read(spark, sf, "events")
    out = analyses.diurnal_profile(ev, "event_type", "ts", "value", tz=LOCAL_TZ)
    return out.select("event_type", "local_hour", F.col("n").alias("n_events"),
                      fr("mean_value", 4).alias("mean_value"), fr("amplitude_pct", 4).alias("amplitude_pct"))


def anomalous_hour_dates(spark, sf, hour: int = 13):
    """The local dates behind one hour-of-day mean."""
    ev = read(spark, sf, "events")
    out = analyses.anomalous_hour_dates(ev, "event_type", "ts", "value", hour, tz=LOCAL_TZ)
    return out.select("event_type", "local_day", F.col("n").alias("n_events"), fr("mean_value", 4).alias("mean_value"))


def around_max(spark, sf, hours: int = 2):
    """Raw rows of the user with the largest jump, ±hours around it."""
    ev = read(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    out = analyses.shape_around_biggest_jump(ev, "user_id", "ts", "value", hours, segment=_day(),
                                             order=["ts", "event_id"], tiebreak=["event_id"])
    return out.select("user_id", "event_id", "ts", "value")


# ---- A14-A21 --------------------------------------------------------------------------
def _nation_volume_balance(spark, sf):
    c = read(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    o = read(spark, sf, "orders").select("o_custkey", "o_totalprice")
    vol = (o.join(c, o.o_custkey == c.c_custkey).groupBy("c_nationkey")
             .agg(F.ln(F.sum("o_totalprice")).alias("log_volume")))
    bal = c.groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("avg_acctbal"))
    return vol.join(bal, "c_nationkey")


def corr_leave_one_out(spark, sf):
    """corr(log volume, balance) over nations, and without each nation."""
    b = _nation_volume_balance(spark, sf)
    out = corr_leave_one_out_op(b, "c_nationkey", "log_volume", "avg_acctbal")
    return out.select("c_nationkey", fr("_x", 6).alias("log_volume"),
                      fr("_y", 6).alias("avg_acctbal"), fr("corr_all", 6).alias("corr_all"),
                      fr("corr_without", 6).alias("corr_without"))


def ratio_of_totals(spark, sf):
    """Ratio of totals beside mean and median of per-row ratios."""
    li = read(spark, sf, "lineitem").withColumn(
        "net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    out = ratio_summary(li, ["l_returnflag"], "l_extendedprice", "net")
    return out.select("l_returnflag", "n_pairs", *[fr(c, 6).alias(c) for c in
                                                   ("ratio_of_totals", "mean_of_ratios", "median_of_ratios")])


def record_length_probe(spark, sf, min_records: int = 70):
    """Per-user record count, first and last, above a threshold."""
    ev = read(spark, sf, "events")
    return record_length(ev, "user_id", "ts", min_count=min_records)


def profile_table(spark, sf):
    """One-pass column profile."""
    li = read(spark, sf, "lineitem")
    return profile(li, ["l_orderkey", "l_quantity", "l_returnflag", "l_shipdate"])


def topk_with_label(spark, sf, k: int = 10):
    """O2 + A17 + J12: k commonest parts, then the label lookup of just those k."""
    li = read(spark, sf, "lineitem")
    top = (li.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n_lines"))
             .orderBy(F.col("n_lines").desc(), F.col("l_partkey").asc()).limit(k))
    p = read(spark, sf, "part").select("p_partkey", "p_name")
    # the top-k side has exactly k rows: broadcast it to cut part down to k
    # labels, then keep every top-k row (label NULL when missing)
    labels = p.join(F.broadcast(top.select("l_partkey")), p.p_partkey == F.col("l_partkey"), "left_semi")
    return (top.join(labels, top.l_partkey == labels.p_partkey, "left")
               .select(F.col("l_partkey").alias("p_partkey"), "p_name", "n_lines"))


# ---- J4 + A23: predecessor pairs --------------------------------------------------------
def _order_pairs(spark, sf) -> DataFrame:
    o = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice",
                                         "o_orderpriority")
    ptr = series_features(o, "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderkey",
                          prev_alias="prev_orderkey", change_alias="_d", rolling_alias=None,
                          segment=F.to_date("o_orderdate")).drop("_d")
    prev = o.select(F.col("o_orderkey").alias("p_key"), F.col("o_orderdate").alias("p_date"),
                    F.col("o_totalprice").alias("p_price"))
    pairs = (ptr.join(prev, ptr.prev_orderkey == prev.p_key, "inner")
                .filter(F.col("o_orderdate") > F.col("p_date")))
    days = F.datediff(F.col("o_orderdate"), F.col("p_date"))
    change = F.round(F.col("o_totalprice") - F.col("p_price"), 2)
    # Annualised-style rate; operands are exact so the ratio is left unrounded
    return pairs.select("o_orderkey", "prev_orderkey", "o_custkey", "o_orderpriority",
                        days.alias("interval_days"), change.alias("price_change"),
                        (change / F.nullif(days, F.lit(0))).alias("daily_rate"))


def predecessor_self_join(spark, sf):
    """J4 + A23: each order joined to the customer's previous order (strictly earlier)."""
    return _order_pairs(spark, sf)


def growth_by_site(spark, sf, min_pairs: int = 50):
    """M23 shape: plausible-interval pairs summarised per priority with HAVING."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    # the pairs come from a window and a self join and are read twice by the
    # percentile passes: materialise just the needed columns once
    pairs = (_order_pairs(spark, sf).filter(F.col("interval_days").between(30, 1000))
             .select("o_orderpriority", "daily_rate", "interval_days").checkpoint(eager=True))
    both = exact_percentiles(pairs, ["o_orderpriority"], "daily_rate", {"median_rate": 0.5, "p90_rate": 0.9},
                             extra={"n_pairs": F.count(F.lit(1)), "mean_rate": fr(F.avg("daily_rate"), 4),
                                    "mean_interval": fr(F.avg("interval_days"), 4)})
    return both.filter(F.col("n_pairs") >= min_pairs).select(
        "o_orderpriority", "n_pairs", "mean_rate", "mean_interval",
        fr("median_rate", 4).alias("median_rate"), fr("p90_rate", 4).alias("p90_rate"))


# ---- P14 + A3 + A22: before / after pairing ------------------------------------------------
def before_after_change(spark, sf):
    """M27-M28 shape: orders timed against each customer's first urgent order
    year; latest pre and post values pivoted; both sides required."""
    o = read(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    ev = (o.filter(F.col("o_orderpriority") == "1-URGENT").groupBy("o_custkey")
            .agg(F.year(F.min("o_orderdate")).alias("event_year")))
    j = (o.join(ev, "o_custkey").withColumn("y", F.year("o_orderdate"))
          .withColumn("timing", timing_label("y", "event_year")))
    pre, post = F.col("timing") == "Pre-fire", F.col("timing") == "Post-fire"
    piv = j.groupBy("o_custkey", "event_year").agg(
        max_when(pre, "y").alias("pre_year"), max_when(post, "y").alias("post_year"),
        max_when(pre, "o_totalprice").alias("pre_total"), max_when(post, "o_totalprice").alias("post_total"))
    return (piv.filter(F.col("pre_year").isNotNull() & F.col("post_year").isNotNull())
               .withColumn("remeasure_interval", F.col("post_year") - F.col("pre_year"))
               .withColumn("total_change", F.round(F.col("post_total") - F.col("pre_total"), 2))
               .withColumn("pct_change", fr(pct_change("post_total", "pre_total"), 4)))


# ---- I1-I5 ----------------------------------------------------------------------------------
def _order_versions(spark, sf):
    o = read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    tgt = o.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")) \
           .withColumn("loaded_at", F.col("o_orderdate"))
    stg = (o.filter(F.col("o_orderdate") >= F.lit("1998-12-01").cast("timestamp_ntz"))
            .select("o_orderkey", "o_custkey", F.lit("F").alias("o_orderstatus"),
                    (F.col("o_totalprice") + 1.0).alias("o_totalprice"), "o_orderdate",
                    (F.col("o_orderdate") + F.make_dt_interval(F.lit(1))).alias("loaded_at"),
                    F.lit(1).alias("revision")))
    return tgt, stg


def merge_incremental(spark, sf):
    """I1 + I2 + I4: lookback-filtered increment (14 days on load time) upserted
    into the target; the increment's new column is appended."""
    tgt, stg = _order_versions(spark, sf)
    inc = incremental.lookback_filter(stg, tgt, "loaded_at", 14)
    return incremental.merge_upsert(tgt, inc, "o_orderkey")


def _supplier_extracts(spark, sf):
    s = read(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    bal = F.col("s_acctbal")
    second = (s.filter(~bal.between(0, 500))
               .select("s_suppkey",
                       F.when(bal < 0, F.concat("s_name", F.lit(" (renamed)"))).otherwise(F.col("s_name")).alias("s_name"),
                       F.when(bal > 9000, F.col("s_nationkey") + 1).otherwise(F.col("s_nationkey")).alias("s_nationkey"),
                       F.when(bal.between(4000, 4500), bal + 100).otherwise(bal).alias("s_acctbal")))
    new = s.filter(bal.between(500, 1000)).select((F.col("s_suppkey") + 1000000).alias("s_suppkey"),
                                                   "s_name", "s_nationkey", "s_acctbal")
    return s, second.unionByName(new)


def scd2_history(spark, sf):
    """Two check-strategy snapshot runs (renames, moves, balance-only
    changes, hard deletes, new keys)."""
    first, second = _supplier_extracts(spark, sf)
    t1, t2 = F.lit("2024-01-01").cast("timestamp_ntz"), F.lit("2024-02-01").cast("timestamp_ntz")
    snap = incremental.scd2_check(None, first, "s_suppkey", ["s_name", "s_nationkey"], t1)
    return incremental.scd2_check(snap, second, "s_suppkey", ["s_name", "s_nationkey"], t2)


# ---- Q1-Q5, Q10, Q11 -------------------------------------------------------------------------
def dq_report(spark, sf):
    """Q11: every check on lineitem in one report (single pass for column checks)."""
    li = read(spark, sf, "lineitem")
    o = read(spark, sf, "orders")
    checks = [
        quality.not_null("l_orderkey"),
        quality.unique(["l_orderkey", "l_linenumber"]),
        quality.accepted_values("l_returnflag", ["A", "N"], severity="warn"),
        quality.accepted_range("l_discount", 0, 0.08),
        quality.relationships("l_orderkey", o, "o_orderkey"),
        quality.expression("price_positive", F.col("l_extendedprice") <= 0),
    ]
    return quality.run_checks(li, checks, table="lineitem")


def freshness(spark, sf):
    """Q10: newest event vs an injected 'now'."""
    ev = read(spark, sf, "events")
    return quality.freshness(ev, "ts", "2024-02-05 00:00:00", 4, 8, source="events")


# ---- F2, F6, P15, P16 ---------------------------------------------------------------------------
def clean_keys(spark, sf):
    """P15 + P16: float-formatted keys cleaned with an anchored regex; names trimmed and upper-cased."""
    o = read(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    txt = F.concat(F.col("o_orderkey").cast("string"), F.lit(".0"))
    cleaned = strip_float_suffix(txt)
    return o.select("o_orderkey", txt.alias("key_text"), cleaned.alias("clean_key"),
                    (cleaned.try_cast("long") == F.col("o_orderkey")).alias("round_trips"),
                    clean_name(F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit(" "))).alias("priority_clean"))


def concat_name(spark, sf):
    """NULL-propagating concatenation."""
    p = read(spark, sf, "part")
    return p.select("p_partkey", F.concat("p_brand", F.lit(" "), "p_type").alias("brand_type"))


def decade_counts(spark, sf):
    """decade = floor(year / 10) * 10."""
    o = read(spark, sf, "orders")
    return o.groupBy(decade(F.year("o_orderdate")).alias("decade")).agg(F.count(F.lit(1)).alias("n_orders"))


# ---- D6-D12 ----------------------------------------------------------------------------------------
def coverage_share(spark, sf):
    """D12 + W6: per nation, customers without orders and the nation's share
    of its region's orders."""
    c = read(spark, sf, "customer").select("c_custkey", "c_nationkey")
    per_cust = read(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    n = read(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    agg = (c.join(per_cust, c.c_custkey == per_cust.o_custkey, "left").groupBy("c_nationkey")
            .agg(F.count(F.lit(1)).alias("n_customers"), count_when(F.col("n").isNull()).alias("idle_customers"),
                 F.coalesce(F.sum("n"), F.lit(0)).alias("n_orders")))
    j = n.join(agg, n.n_nationkey == agg.c_nationkey, "left").select(
        "n_nationkey", "n_name", "n_regionkey", F.coalesce("n_customers", F.lit(0)).alias("n_customers"),
        F.coalesce("idle_customers", F.lit(0)).alias("idle_customers"),
        F.coalesce("n_orders", F.lit(0)).alias("n_orders"))
    out = share_of_parent(j, ["n_regionkey"], "n_orders", "pct_of_region")
    return out.withColumn("pct_of_region", fr("pct_of_region", 4))


def genus_rollup(spark, sf):
    """Roll-up by the first word of the part name."""
    li = read(spark, sf, "lineitem").select("l_partkey", "l_returnflag", "l_extendedprice")
    p = read(spark, sf, "part").select("p_partkey", F.substring_index("p_name", " ", 1).alias("genus"))
    j = li.join(p, li.l_partkey == p.p_partkey)
    ret = F.col("l_returnflag") == "R"
    return (j.groupBy("genus").agg(F.count(F.lit(1)).alias("n_lines"), count_when(ret).alias("returned_lines"))
             .withColumn("pct_returned", fr(safe_pct("returned_lines", "n_lines"), 4)))


def owner_summary(spark, sf):
    """Per supplier nation, share returned by count and by value (cents)."""
    li = read(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_extendedprice")
    s = read(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(s, li.l_suppkey == s.s_suppkey)
    ret = F.col("l_returnflag") == "R"
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    agg = j.groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("n_lines"), count_when(ret).alias("returned_lines"),
        F.sum(cents).alias("_tot"), F.sum(F.when(ret, cents).otherwise(F.lit(0).cast("long"))).alias("_ret"))
    return agg.select("s_nationkey", "n_lines", "returned_lines",
                      fr(safe_pct("returned_lines", "n_lines"), 4).alias("pct_returned_by_count"),
                      fr(safe_pct("_ret", "_tot"), 4).alias("pct_returned_by_value"))


def stand_structure(spark, sf):
    """M25 shape: open lines by flag and quantity class with share of the flag's lines."""
    from ..constants import DIAMETER_CLASSES
    from ..functions.shape import bin_below
    li = read(spark, sf, "lineitem").filter(F.col("l_linestatus") == "O")
    agg = (li.withColumn("quantity_class", bin_below("l_quantity", DIAMETER_CLASSES))
             .groupBy("l_returnflag", "quantity_class")
             .agg(F.count(F.lit(1)).alias("line_count"), F.sum("l_quantity").alias("sum_qty"),
                  fr(F.avg("l_discount"), 4).alias("avg_discount")))
    out = share_of_parent(agg, ["l_returnflag"], "line_count", "pct_of_lines")
    return out.withColumn("pct_of_lines", fr("pct_of_lines", 4))


# ---- §7.3 names for operators that the queries above already combine ----------------------------
def rb_flashiness(spark, sf):
    """A10: Richards-Baker flashiness per region and water year."""
    from .mapped import water_year_summary as _wys_q
    w = _wys_q(spark, sf)
    return w.select("region", "water_year", "sum_abs_change", "sum_discharge", "rb_flashiness_index")


def wettest_rank(spark, sf):
    """Rank of each complete water year by volume within its region."""
    from .mapped import water_year_summary as _wys_q
    w = _wys_q(spark, sf)
    return w.select("region", "water_year", "annual_volume_af", "wettest_year_rank")


def lookback(spark, sf):
    """The increment that passes the 14-day lookback on load time."""
    tgt, stg = _order_versions(spark, sf)
    return incremental.lookback_filter(stg, tgt, "loaded_at", 14)


def append_columns(spark, sf):
    """I4: after the upsert the increment's new column exists for every row
    (NULL for rows the increment did not touch)."""
    return merge_incremental(spark, sf).select("o_orderkey", "o_orderstatus", "revision")


def top_values(spark, sf):
    """The 10 commonest part keys of lineitem (count desc, key asc)."""
    from ..operators.aggregates import top_values as _tv
    return _tv(read(spark, sf, "lineitem"), "l_partkey", 10)


# ---- I8: streaming form -------------------------------------------------------------------------
def stream_dedup(spark, sf):
    """I8: the events file replayed as a stream (availableNow), watermarked
    first-wins dedup per (user, type, day), written by a Parquet file sink
    under the shared checkpoint folder and read back."""
    import uuid

    from ..session import shared_path
    from ..streaming import landing
    path = f"{sf.rstrip('/')}/events.parquet"
    schema = spark.read.parquet(path).schema
    # the file source lists a directory or a glob; the glob names just this table
    stream = (spark.readStream.schema(schema).parquet(f"{sf.rstrip('/')}/events*.parquet")
                   .withColumn("day", F.to_date("ts")))
    dedup = landing.stream_first_wins(stream, ["user_id", "event_type", "day"], "ts", delay="1 day")
    run = uuid.uuid4().hex
    out, ck = shared_path(spark, "streams", run, "out"), shared_path(spark, "streams", run, "ck")
    q = (dedup.select("user_id", "event_type", "day").writeStream.format("parquet")
              .option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema("user_id long, event_type string, day date").parquet(out)


# ---- A18, S14 -----------------------------------------------------------------------------------------
def class_summary(spark, sf):
    """Count and mean per class (mean of integer cents, exact)."""
    from .marts import class_summary as _cs
    o = read(spark, sf, "orders").withColumn("total_cents", F.round(F.col("o_totalprice") * 100).cast("long"))
    out = _cs(o, "o_orderpriority", {"mean_total_cents": "total_cents"}, digits=None)
    return out.select("o_orderpriority", F.col("n").alias("n_orders"),
                      (F.col("mean_total_cents") / 100.0).alias("mean_total"))


def load_audit(spark, sf):
    """Row count and year coverage of a loaded table in one pass."""
    from ..sources.tables import load_audit as _audit
    o = read(spark, sf, "orders").withColumn("order_year", F.year("o_orderdate"))
    return _audit(o, "order_year", since_year=2000)


QUERIES = {
    "rb_flashiness": rb_flashiness,
    "wettest_rank": wettest_rank,
    "lookback": lookback,
    "append_columns": append_columns,
    "top_values": top_values,
    "stream_dedup": stream_dedup,
    "anomalous_hour_dates": anomalous_hour_dates,
    "class_summary": class_summary,
    "load_audit": load_audit,
    "variant_project": variant_project,
    "lag_change_rolling": lag_change_rolling,
    "daily_flow_features": daily_flow_features,
    "share_of_group": share_of_group,
    "top_jumps": top_jumps,
    "jump_by_weekday": jump_by_weekday,
    "diurnal_profile": diurnal_profile,
    "around_max": around_max,
    "corr_leave_one_out": corr_leave_one_out,
    "ratio_of_totals": ratio_of_totals,
    "record_length": record_length_probe,
    "profile_table": profile_table,
    "topk_with_label": topk_with_label,
    "predecessor_self_join": predecessor_self_join,
    "growth_by_site": growth_by_site,
    "before_after_change": before_after_change,
    "merge_incremental": merge_incremental,
    "scd2_history": scd2_history,
    "dq_report": dq_report,
    "freshness": freshness,
    "clean_keys": clean_keys,
    "concat_name": concat_name,
    "decade": decade_counts,
    "coverage_share": coverage_share,
    "genus_rollup": genus_rollup,
    "owner_summary": owner_summary,
    "stand_structure": stand_structure,
}
