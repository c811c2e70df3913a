"""A*: grouped aggregates, exact percentiles, mode, shares, hydrology indices.

Every aggregate here is partial + final (map-side combine), so a group that
holds a large share of rows is reduced on the map side before any shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..constants import CUBIC_FEET_PER_ACRE_FOOT, SECONDS_PER_DAY
from ..session import ensure_checkpoint_dir
from .joins import attach_scalar, join_null_safe


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


# ---- A2: conditional aggregates ---------------------------------------------
def count_when(cond: Column) -> Column:
    """``sum(case when cond then 1 else 0 end)`` as a long."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def sum_when(cond: Column, value) -> Column:
    return F.sum(F.when(cond, _c(value)))


def avg_when(cond: Column, value) -> Column:
    return F.avg(F.when(cond, _c(value)))


def max_when(cond: Column, value) -> Column:
    return F.max(F.when(cond, _c(value)))


# ---- A4/A5: exact percentile_cont without gathering a group in one task -------
FEW_BRACKETS = 10_000   # as many (group, p) pairs travel to the rows instead
HOT_ROWS = 1_000_000    # so do those of groups with more rows


def _meet_brackets(base: DataFrame, brackets: DataFrame, g: list, hot_rows: int | None = None) -> DataFrame:
    """``base`` joined to the brackets of its group.  Few brackets are sent to
    the rows.  Of many, those of groups with more than ``hot_rows`` rows are
    (there are at most rows / hot_rows of such groups); only the rows of the
    other groups are dealt by group, so no task ever sorts a large group."""
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    if brackets.count() <= FEW_BRACKETS:
        return join_null_safe(base, F.broadcast(brackets), g, "inner")
    hot = brackets.filter(F.col("_n") > hot_rows)
    if hot.isEmpty():
        return join_null_safe(base, brackets, g, "inner")
    others = join_null_safe(base, F.broadcast(hot.select(*g).distinct()), g, "left_anti")
    return (join_null_safe(base, F.broadcast(hot), g, "inner")
            .unionByName(join_null_safe(others, brackets.filter(F.col("_n") <= hot_rows), g, "inner")))


def _refine_brackets(base: DataFrame, need: DataFrame, g: list, accuracy: int, steps: int = 1000) -> DataFrame:
    """Second pass for (group, p) pairs whose bracket is still too wide: sketch
    only the values inside the bracket at ``steps`` + 1 evenly spaced
    quantiles, then keep the two sketch points around each target rank."""
    nb = need.select(*g, "_pname", "_p", "_n", "_blo", "_bhi")
    j = _meet_brackets(base, nb, g)
    inside = (F.col("_v") >= F.col("_blo")) & (F.col("_v") <= F.col("_bhi"))
    qs = [i / steps for i in range(steps + 1)]
    agg = j.groupBy(*g, "_pname", "_p", "_n", "_blo", "_bhi").agg(
        F.count_if(F.col("_v") < F.col("_blo")).alias("_below"),
        F.count_if(inside).alias("_within"),
        F.percentile_approx(F.when(inside, F.col("_v")), qs, accuracy).alias("_q"))
    pos = F.col("_p") * (F.col("_n") - 1)
    span = F.greatest(F.col("_within") - 1, F.lit(1)).cast("double")
    lo_rank = F.floor(pos) + 1 - F.col("_below")          # 1-based ranks inside the bracket
    hi_rank = F.ceil(pos) + 1 - F.col("_below")
    # each sketch point may be off by within/accuracy ranks = steps/accuracy points
    margin = int(math.ceil(3.0 * steps / accuracy)) + 2
    ilo = F.greatest(F.floor((lo_rank - 1) / span * steps) - margin, F.lit(0)).cast("int")
    ihi = F.least(F.ceil((hi_rank - 1) / span * steps) + margin, F.lit(steps)).cast("int")
    return agg.select(*g, "_n", "_pname", "_p",
                      F.coalesce(F.get(F.col("_q"), ilo), F.col("_blo")).alias("_blo"),
                      F.coalesce(F.get(F.col("_q"), ihi), F.col("_bhi")).alias("_bhi"))


def exact_percentiles(df: DataFrame, group_cols, value_col, probs: dict, accuracy: int = 10000,
                      eager_check: bool = True, extra: dict | None = None,
                      max_candidates: int | None = 2_000_000) -> DataFrame:
    """``percentile_cont(p) within group (order by value)`` per group, exact.

    Plan: (1) per group, ``count`` plus a bounded-memory quantile sketch gives a
    value bracket around each target rank (groups so large that the bracket
    would still hold more than ``max_candidates`` values get one refinement
    pass that sketches only the values inside it); (2) one partial aggregation counts
    the rows below the bracket and the rows per distinct value inside it
    (bounded by the sketch error, so never a whole hot group); (3) a window
    over that small table finds the exact order statistics.  Should the
    sketch ever miss its bracket (it should not: the bracket is wider than the
    sketch's rank error), the affected groups are recomputed exactly with
    ``percentile``; the check runs on the small per-group result, which is
    checkpointed first.  ``eager_check=False`` keeps the function lazy and
    trusts the sketch bound.
    Returns one row per group with one column per name in ``probs``.
    ``extra`` (name -> aggregate Column) is computed in the same first pass
    (over all rows, NULL values included), which saves callers a separate
    scan.  Every group is returned; a group whose values are all NULL gets
    NULL percentiles.
    """
    g = _list(group_cols)
    names = list(probs)
    base = (df.select(*g, _c(value_col).cast("double").alias("_v"))
              .filter(F.col("_v").isNotNull() & ~F.isnan("_v")))
    margin = 3.0 / accuracy
    lo_ps = [max(0.0, probs[n] - margin) for n in names]
    hi_ps = [min(1.0, probs[n] + margin) for n in names]
    vcol = _c(value_col).cast("double")
    vclean = F.when(~F.isnan(vcol), vcol)
    extra = dict(extra or {})
    # one sketch per group answers both bracket ends of every probability
    k = len(names)
    stats = df.groupBy(*g).agg(
        F.count(vclean).alias("_n"),
        F.percentile_approx(vclean, lo_ps + hi_ps, accuracy).alias("_q"),
        *[c.alias(n) for n, c in extra.items()])
    stats = stats.select(*g, "_n", F.slice("_q", 1, k).alias("_lo"), F.slice("_q", k + 1, k).alias("_hi"),
                         *extra.keys())
    if eager_check:
        ensure_checkpoint_dir(df.sparkSession)
        # one row per group, written once to the shared checkpoint folder:
        # both the bracket pass and the final per-group table read it, so the
        # input is scanned exactly twice (sketch pass, bracket pass)
        stats = stats.checkpoint(eager=True)
    stats_nz = stats.filter(F.col("_n") > 0)
    brackets = stats_nz.select(*g, "_n", F.explode(F.array(*[
        F.struct(F.lit(n).alias("_pname"), F.lit(float(probs[n])).alias("_p"),
                 F.get(F.col("_lo"), i).alias("_blo"), F.get(F.col("_hi"), i).alias("_bhi"))
        for i, n in enumerate(names)])).alias("_b")).select(*g, "_n", "_b.*")
    if eager_check and max_candidates is not None:
        # a very large group would still leave ~6·n/accuracy candidate values
        # for one window partition: narrow those brackets with one more pass
        need = brackets.filter(F.col("_n") * (6.0 / accuracy) > max_candidates)
        if not need.isEmpty():
            refined = _refine_brackets(base, need, g, accuracy)
            keep = join_null_safe(brackets, need.select(*g, "_pname"), [*g, "_pname"], "left_anti")
            brackets = keep.unionByName(refined.select(*keep.columns)).checkpoint(eager=True)
    cls = (F.when(F.col("_v") < F.col("_blo"), 0)
            .when(F.col("_v") > F.col("_bhi"), 2).otherwise(1))
    # stats are written by now only with eager_check: otherwise nothing is counted ahead
    met = _meet_brackets(base, brackets, g) if eager_check else join_null_safe(base, brackets, g, "inner")
    counted = (met.withColumn("_cls", cls)
               .withColumn("_kv", F.when(F.col("_cls") == 1, F.col("_v")))
               .groupBy(*g, "_pname", "_p", "_n", "_cls", "_kv")
               .agg(F.count(F.lit(1)).alias("_cnt")))
    w = (W.partitionBy(*g, "_pname").orderBy("_cls", "_kv")
         .rowsBetween(W.unboundedPreceding, W.currentRow))
    pos = F.col("_p") * (F.col("_n") - 1)
    ranked = (counted.withColumn("_cum", F.sum("_cnt").over(w))
              .withColumn("_start", F.col("_cum") - F.col("_cnt") + 1)
              .withColumn("_rlo", F.floor(pos) + 1)
              .withColumn("_rhi", F.ceil(pos) + 1)
              .withColumn("_frac", pos - F.floor(pos)))
    hit_lo = (F.col("_start") <= F.col("_rlo")) & (F.col("_rlo") <= F.col("_cum"))
    hit_hi = (F.col("_start") <= F.col("_rhi")) & (F.col("_rhi") <= F.col("_cum"))
    aggs = []
    for n in names:
        mine = F.col("_pname") == n
        aggs += [F.max(F.when(mine & hit_lo, F.col("_kv"))).alias(f"_lo_{n}"),
                 F.max(F.when(mine & hit_hi, F.col("_kv"))).alias(f"_hi_{n}"),
                 F.max(F.when(mine, F.col("_frac"))).alias(f"_fr_{n}")]
    aggs.append(F.max(F.when((hit_lo | hit_hi) & (F.col("_cls") != 1), 1).otherwise(0)).alias("_miss"))
    wide = ranked.groupBy(*g).agg(*aggs).select(
        *g, *[(F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_fr_{n}")).alias(n)
              for n in names], "_miss")
    # every group (an all-NULL group gets NULL percentiles, as in SQL) with
    # its extra aggregates
    full = join_null_safe(stats.select(*g, *extra.keys()), wide, g, "left")
    cols = [*g, *extra.keys(), *names]
    if not eager_check:
        return full.select(*cols)
    # one row per group: materialise it in the shared checkpoint folder so the
    # miss check below does not recompute the pipeline
    full = full.checkpoint(eager=True)
    missed = full.filter(F.col("_miss") == 1).select(*g)
    if missed.isEmpty():
        return full.select(*cols)
    # exact fallback for groups whose sketch bracket missed the target rank
    redo = (join_null_safe(base, missed, g, "left_semi").groupBy(*g)
            .agg(*[F.percentile("_v", float(probs[n])).alias(f"_fb_{n}") for n in names]))
    out = join_null_safe(full, redo, g, "left")
    return out.select(*g, *extra.keys(), *[F.coalesce(F.col(f"_fb_{n}"), F.col(n)).alias(n) for n in names])


def exact_median(df, group_cols, value_col, alias="median") -> DataFrame:
    return exact_percentiles(df, group_cols, value_col, {alias: 0.5})


# ---- A6: mode ------------------------------------------------------------------
def group_mode(df: DataFrame, group_cols, value_col, alias: str = "mode") -> DataFrame:
    """Most common non-NULL value per group; ties -> smallest value.

    Counts per (group, value) first (partial aggregation), then a ``min`` over
    ``struct(-count, value)``, so no group is gathered into one task."""
    g = _list(group_cols)
    counts = (df.filter(_c(value_col).isNotNull())
                .groupBy(*g, _c(value_col).alias("_mv")).agg(F.count(F.lit(1)).alias("_mc")))
    best = F.min(F.struct((-F.col("_mc")).alias("_negc"), F.col("_mv").alias("_mv")))
    return counts.groupBy(*g).agg(best.alias("_best")).select(*g, F.col("_best._mv").alias(alias))


# ---- W6: share within a parent group -----------------------------------------------
def share_of_parent(counted: DataFrame, parent_cols, count_col: str, alias: str = "pct_of_parent") -> DataFrame:
    """``n * 100.0 / sum(n) over (partition by parent)`` on an aggregated table.
    Without parent columns the grand total comes from a scalar subquery, not
    from a window over one global partition."""
    parents = _list(parent_cols)
    if not parents:
        tot = counted.agg(F.sum(count_col).cast("double").alias("_fl_total"))
        return (attach_scalar(counted, tot)
                .withColumn(alias, F.col(count_col).cast("double") * 100.0 / F.col("_fl_total"))
                .drop("_fl_total"))
    w = W.partitionBy(*parents)
    return counted.withColumn(
        alias, F.col(count_col).cast("double") * 100.0 / F.sum(count_col).over(w).cast("double"))


# ---- A10/A11: hydrology ------------------------------------------------------------
def rb_flashiness(sum_abs_change, sum_flow) -> Column:
    """Richards-Baker index ``sum|dQ| / sum Q``; NULL unless sum Q > 0."""
    return F.when(_c(sum_flow) > 0, _c(sum_abs_change) / _c(sum_flow))


def annual_volume_af(sum_cfs) -> Column:
    return _c(sum_cfs) * SECONDS_PER_DAY / CUBIC_FEET_PER_ACRE_FOOT


# ---- A20: correlation with leave-one-out ---------------------------------------------
def corr_leave_one_out(df: DataFrame, id_cols, x, y, group_cols=None) -> DataFrame:
    """Per row: corr(x, y) of its group without that row, from one pass of
    sums (Σx, Σy, Σxy, Σx², Σy², n) minus the row's own terms."""
    g = _list(group_cols)
    base = df.select(*_list(id_cols), *g, _c(x).cast("double").alias("_x"),
                     _c(y).cast("double").alias("_y")).filter(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    tot = base.groupBy(*g).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_x").alias("_sx"), F.sum("_y").alias("_sy"),
        F.sum(F.col("_x") * F.col("_y")).alias("_sxy"), F.sum(F.col("_x") * F.col("_x")).alias("_sxx"),
        F.sum(F.col("_y") * F.col("_y")).alias("_syy"), F.corr("_x", "_y").alias("corr_all"))
    # per-group totals: one row per group (join); without groups: one row
    j = join_null_safe(base, tot, g, "inner") if g else attach_scalar(base, tot)
    n = F.col("_n") - 1
    sx, sy = F.col("_sx") - F.col("_x"), F.col("_sy") - F.col("_y")
    sxy = F.col("_sxy") - F.col("_x") * F.col("_y")
    sxx, syy = F.col("_sxx") - F.col("_x") * F.col("_x"), F.col("_syy") - F.col("_y") * F.col("_y")
    num = n * sxy - sx * sy
    den = F.sqrt((n * sxx - sx * sx) * (n * syy - sy * sy))
    return j.select(*_list(id_cols), *g, "_x", "_y", "corr_all",
                    F.when(den > 0, num / den).alias("corr_without"))


# ---- A21: ratio of totals vs mean / median of ratios ----------------------------------
def ratio_summary(df: DataFrame, group_cols, before, after, prefix: str = "") -> DataFrame:
    """Per group: Σafter/Σbefore − 1, mean and median of (after/before − 1);
    rows with both sides present and before ≠ 0 (N16)."""
    g = _list(group_cols)
    base = (df.select(*g, _c(before).cast("double").alias("_b"), _c(after).cast("double").alias("_a"))
              .filter(F.col("_b").isNotNull() & F.col("_a").isNotNull() & (F.col("_b") != 0))
              .withColumn("_r", F.col("_a") / F.col("_b") - 1))
    tot = base.groupBy(*g).agg(
        F.count(F.lit(1)).alias(f"{prefix}n_pairs"),
        (F.sum("_a") / F.sum("_b") - 1).alias(f"{prefix}ratio_of_totals"),
        F.avg("_r").alias(f"{prefix}mean_of_ratios"))
    med = exact_percentiles(base, g, "_r", {f"{prefix}median_of_ratios": 0.5})
    return join_null_safe(tot, med, g, "left") if g else attach_scalar(tot, med)


# ---- A14/A15: record-length probe ---------------------------------------------------
def record_length(df: DataFrame, entity, time, min_count: int | None = None) -> DataFrame:
    """Count / first / last per entity, optional threshold; caller orders."""
    out = df.groupBy(*_list(entity)).agg(
        F.count(_c(time)).alias("n_records"), F.min(_c(time)).alias("first_seen"),
        F.max(_c(time)).alias("last_seen"))
    if min_count is not None:
        out = out.filter(F.col("n_records") >= min_count)
    return out


# ---- A16: dataset profile -------------------------------------------------------------
def profile(df: DataFrame, columns=None, exact_distinct: bool = True) -> DataFrame:
    """One row per column: rows, non-null, distinct, min, max (as strings).

    Counts / min / max come from one global aggregation.  Exact distinct
    counts come from a single hash aggregation over (column, value) pairs
    (partial aggregation first, so repeated values never cross the shuffle
    twice); ``exact_distinct=False`` uses HyperLogLog instead (no shuffle of
    values at all)."""
    cols = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        aggs += [F.count(F.col(c)).alias(f"_nn{i}"), F.min(F.col(c)).cast("string").alias(f"_mn{i}"),
                 F.max(F.col(c)).cast("string").alias(f"_mx{i}")]
        if not exact_distinct:
            aggs.append(F.approx_count_distinct(F.col(c)).alias(f"_nd{i}"))
    one = df.agg(*aggs)
    stats = one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("n_rows"),
                 F.col(f"_nn{i}").alias("n_non_null"),
                 (F.col(f"_nd{i}").cast("long") if not exact_distinct else F.lit(None).cast("long")).alias("_nd"),
                 F.col(f"_mn{i}").alias("min_value"), F.col(f"_mx{i}").alias("max_value"))
        for i, c in enumerate(cols)])).alias("_r")).select("_r.*")
    if not exact_distinct:
        return stats.select("column_name", "n_rows", "n_non_null", F.col("_nd").alias("n_distinct"),
                            "min_value", "max_value")
    # values keep their own type inside a per-column struct slot, so equality
    # is the column's own (no string round trip)
    slots = [F.struct(*[(F.col(c) if j == i else F.lit(None).cast(df.schema[c].dataType)).alias(f"v{j}")
                        for j, c in enumerate(cols)]) for i in range(len(cols))]
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), slots[i].alias("v"),
                                                    F.col(c).isNull().alias("_isnull"))
                                          for i, c in enumerate(cols)])).alias("_p")).select("_p.*")
    distinct = (pairs.filter(~F.col("_isnull")).select("column_name", "v").distinct()
                     .groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct")))
    return (stats.join(distinct, "column_name", "left")
                 .select("column_name", "n_rows", "n_non_null",
                         F.coalesce("n_distinct", F.lit(0).cast("long")).alias("n_distinct"), "min_value", "max_value"))


# ---- A17: top-k value frequency ----------------------------------------------------
def top_values(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """k commonest values with a total order (count desc, value asc)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.col("n").desc(), F.col(col).asc_nulls_last()).limit(k))
