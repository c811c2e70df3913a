"""W*: per-entity series windows (lag, change, centred rolling mean), ranks,
largest single steps and the raw shape around them.

A plain ``Window.partitionBy(entity)`` sends every row of one entity to one
task.  When ``segment`` is given (a Column that is monotone in the order, e.g.
the day of a timestamp), the window runs per (entity, segment) and only the
rows near each segment edge are recomputed over the small set of edge rows of
the entity, so a hot entity is spread over as many tasks as it has segments.
``RANGES`` as segment takes the pieces of a range sort by entity and order:
they follow the rows, so a busy hour is split as well as a busy entity.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..sources import ordered

#: segments that follow the rows: pieces of a stored range sort
RANGES = "ranges"

def _list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


def _order_cols(order) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in _list(order)]


def row_window(df: DataFrame, entity, order, exprs: Callable[[W], dict], reach: int,
               segment: Column | str | None = None, n_parts: int | None = None) -> DataFrame:
    """Add the columns ``exprs(window)`` (row-frame windows reaching at most
    ``reach`` rows either side of the current row) per entity in ``order``.

    ``order`` must be total within an entity.  With ``segment`` the result is
    identical to the plain window but no task holds more than one segment.
    ``RANGES`` stores the rows range-sorted in the shared folder first and
    takes each entity's share of a partition as a segment (``n_parts``
    partitions, by default as many as their size asks for)."""
    ent, ordc = _list(entity), _order_cols(order)
    if segment is None:
        w = W.partitionBy(*ent).orderBy(*ordc)
        out = df
        for name, col in exprs(w).items():
            out = out.withColumn(name, col)
        return out
    staged = isinstance(segment, str)
    if staged:
        if segment != RANGES:
            raise ValueError(f"segment is a column or {RANGES!r}")
        df = ordered.stage_ordered(df, [F.col(c) if isinstance(c, str) else c for c in ent] + ordc, n_parts)
        segment = ordered.part_of()
    k = max(1, int(reach))
    seg_w = W.partitionBy(*ent, "_fl_seg").orderBy(*ordc)
    x = (df.withColumn("_fl_seg", segment)
           .withColumn("_fl_rn", F.row_number().over(seg_w))
           .withColumn("_fl_cnt", F.count(F.lit(1)).over(W.partitionBy(*ent, "_fl_seg"))))
    inner = x
    for name, col in exprs(seg_w).items():
        inner = inner.withColumn(name, col)
    interior = inner.filter((F.col("_fl_rn") > k) & (F.col("_fl_rn") <= F.col("_fl_cnt") - k))
    # rows within 2k of a segment edge carry every neighbour an edge row needs
    edge_set = x.filter((F.col("_fl_rn") <= 2 * k) | (F.col("_fl_rn") > F.col("_fl_cnt") - 2 * k))
    ent_w = W.partitionBy(*ent).orderBy(*ordc)
    edge = edge_set
    for name, col in exprs(ent_w).items():
        edge = edge.withColumn(name, col)
    edge = edge.filter((F.col("_fl_rn") <= k) | (F.col("_fl_rn") > F.col("_fl_cnt") - k))
    return interior.unionByName(edge).drop("_fl_seg", "_fl_rn", "_fl_cnt", *([ordered.PLACE] if staged else []))


def series_features(df: DataFrame, entity, order, value: str, *, prev_alias: str = "prev_value",
                    change_alias: str = "change", rolling_alias: str | None = "rolling_mean",
                    before: int = 3, after: int = 3, segment: Column | str | None = None) -> DataFrame:
    """Previous value, change = value - previous, and a centred
    row-based rolling mean (``rows between before preceding and after
    following``, shorter at the ends)."""
    v = F.col(value)

    def exprs(w):
        out = {prev_alias: F.lag(v).over(w), change_alias: v - F.lag(v).over(w)}
        if rolling_alias:
            out[rolling_alias] = F.avg(v).over(w.rowsBetween(-before, after))
        return out

    reach = max(1, before, after) if rolling_alias else 1
    return row_window(df, entity, order, exprs, reach, segment)


def rank_within(df: DataFrame, partition, order_col: str, alias: str = "rank", desc: bool = True) -> DataFrame:
    """``rank() over (partition by .. order by col desc)``, NULL first on
    DESC as in the warehouse (N1)."""
    o = F.col(order_col).desc_nulls_first() if desc else F.col(order_col).asc_nulls_last()
    return df.withColumn(alias, F.rank().over(W.partitionBy(*_list(partition)).orderBy(o)))


def top_steps(df: DataFrame, change_col: str, k: int, tiebreak) -> DataFrame:
    """K largest |change| (NULL changes removed first); total order by
    ``tiebreak``.  Planned as a bounded per-partition top-k + merge."""
    return (df.filter(F.col(change_col).isNotNull())
              .withColumn("abs_change", F.abs(F.col(change_col)))
              .orderBy(F.col("abs_change").desc(), *_order_cols(tiebreak)).limit(k))


def around_event(series: DataFrame, events: DataFrame, entity, time_col: str,
                 before, after) -> DataFrame:
    """Raw rows of each event's entity within [t - before, t + after].

    ``events`` carries ``entity`` and ``event_time``; it is a top-k result, so
    its size is bounded by k and it is broadcast."""
    ent = _list(entity)
    ev = events.select(*ent, F.col("event_time"))
    cond = [series[c] == ev[c] for c in ent] + [
        series[time_col] >= ev["event_time"] - before,
        series[time_col] <= ev["event_time"] + after]
    return series.join(F.broadcast(ev), on=cond, how="inner").drop(*[ev[c] for c in ent])
