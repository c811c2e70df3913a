"""K2-K7: keep-one-per-key and duplicate reporting.

All keep-one forms use ``row_number() = 1``: Spark plans a *partial*
``WindowGroupLimit`` before the shuffle, so a key holding a large share of
rows is cut to one row per map task before it is exchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def _order(cols, desc: bool, nulls: str) -> list[Column]:
    out = []
    for c in cols:
        if isinstance(c, Column):
            out.append(c)
            continue
        col = F.col(c)
        if desc:
            out.append(col.desc_nulls_first() if nulls == "first" else col.desc_nulls_last())
        else:
            out.append(col.asc_nulls_first() if nulls == "first" else col.asc_nulls_last())
    return out


def keep_one(df: DataFrame, keys, order: list, tiebreak: list | None = None) -> DataFrame:
    """Keep the first row per ``keys`` under ``order`` (Columns with explicit
    null ordering).  ``tiebreak`` columns make the choice total (N3)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    tb = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in (tiebreak or [])]
    w = W.partitionBy(*keys).orderBy(*(list(order) + tb))
    return df.withColumn("_fl_rn", F.row_number().over(w)).filter(F.col("_fl_rn") == 1).drop("_fl_rn")


def keep_first(df, keys, by, tiebreak=None, nulls: str = "last") -> DataFrame:
    """K2: earliest wins (``order by by asc``; NULL last as in the warehouse)."""
    by = [by] if isinstance(by, str) else list(by)
    return keep_one(df, keys, _order(by, False, nulls), tiebreak)


def keep_last(df, keys, by, tiebreak=None, nulls: str = "first") -> DataFrame:
    """K3: latest wins (``order by by desc``; warehouse puts NULL first on DESC)."""
    by = [by] if isinstance(by, str) else list(by)
    return keep_one(df, keys, _order(by, True, nulls), tiebreak)


def keep_largest(df, keys, measure, tiebreak=None, nulls: str = "first") -> DataFrame:
    """K4: largest measure per key."""
    return keep_last(df, keys, measure, tiebreak, nulls)


def dominant_child(df, parent, weight, tiebreak) -> DataFrame:
    """K5: largest weight per parent, NULL weight last, ties by ``tiebreak`` asc."""
    tiebreak = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    return keep_one(df, parent, [F.col(weight).desc_nulls_last()], tiebreak)


def latest_per_entity(df, entity, time, tiebreak=None) -> DataFrame:
    """K6: newest per entity, NULL time last."""
    return keep_one(df, entity, [F.col(time).desc_nulls_last()], tiebreak)


def duplicate_report(df: DataFrame, keys) -> DataFrame:
    """K7: keys appearing more than once with their count (partial aggregation
    collapses hot keys map-side)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))
