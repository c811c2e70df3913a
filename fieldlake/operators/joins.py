"""J1-J12 helpers.  Join strategies are left to AQE, which re-plans from
runtime sizes in bytes and splits skewed partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

def join_null_safe(left: DataFrame, right: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (``<=>``), as GROUP BY
    treats NULL keys as one group.  Planned as a normal hash / sort-merge
    join; the output keeps one copy of the keys (the left one, or the right
    one for rows only the right side has)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not keys:
        raise ValueError("join_null_safe needs keys")
    r = right.select(*[F.col(f"`{c}`").alias(f"_r_{c}") if c in keys else F.col(f"`{c}`") for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    j = left.join(r, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return j
    if how in ("right", "right_outer", "full", "full_outer", "outer"):
        fixed = [F.coalesce(left[k], F.col(f"_r_{k}")).alias(k) if k in keys else left[k] for k in left.columns]
    else:
        fixed = [left[k] for k in left.columns]
    others = [F.col(f"`{c}`") for c in r.columns if not c.startswith("_r_") or c[3:] not in keys]
    return j.select(*fixed, *others)


def attach_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a single-row aggregate to every row as a scalar
    subquery (``DataFrame.scalar()``): the aggregate runs once and its values
    are substituted into the projection -- no join, no all-pairs operator."""
    s = "_fl_scalar"
    packed = one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns]).alias(s)).scalar()
    return df.withColumn(s, packed).select(*[F.col(f"`{c}`") for c in df.columns],
                                           *[F.col(s)[c].alias(c) for c in one_row.columns])


def scoped_join(fact: DataFrame, dim: DataFrame, on) -> DataFrame:
    """Inner join keeping only facts whose key is in the dimension."""
    return fact.join(dim, on=on, how="inner")


def lookup(fact: DataFrame, dim: DataFrame, on) -> DataFrame:
    """Left join that keeps facts without a match."""
    return fact.join(dim, on=on, how="left")


def present_in(df: DataFrame, other: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows whose key appears in ``other`` (left semi join)."""
    return df.join(other.select(F.col(right_key).alias("_fl_k")), F.col(left_key) == F.col("_fl_k"), "left_semi")


def missing_from(df: DataFrame, other: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Non-null keys without a partner (left anti join)."""
    return (df.filter(F.col(left_key).isNotNull())
              .join(other.select(F.col(right_key).alias("_fl_k")), F.col(left_key) == F.col("_fl_k"), "left_anti"))


def coverage(candidates: DataFrame, observations: DataFrame, key: str, time_col: str,
             start=None, end=None) -> DataFrame:
    """J11 + A15: every candidate reported with count/first/last of its
    observations inside [start, end] (0 / NULL when none)."""
    obs = observations
    if start is not None:
        obs = obs.filter(F.col(time_col) >= F.lit(start).cast(observations.schema[time_col].dataType))
    if end is not None:
        obs = obs.filter(F.col(time_col) <= F.lit(end).cast(observations.schema[time_col].dataType))
    stats = obs.groupBy(key).agg(F.count(F.lit(1)).alias("n_obs"), F.min(time_col).alias("first_obs"),
                                 F.max(time_col).alias("last_obs"))
    return (candidates.join(stats, on=key, how="left")
                      .withColumn("n_obs", F.coalesce("n_obs", F.lit(0).cast("long"))))


def salted_join(big: DataFrame, small: DataFrame, on, buckets: int, how: str = "inner") -> DataFrame:
    """Equi-join that spreads a hot key of ``big`` over ``buckets`` tasks.

    ``big`` rows get a salt from a hash of the whole row (deterministic, so a
    retried task salts the same way); ``small`` is replicated once per salt.
    Each ``big`` row meets every matching ``small`` row exactly once, so the
    result equals the plain join.  For the join types where AQE cannot split
    the skewed side; ``how`` is ``inner`` or ``left`` (``big`` preserved)."""
    if how not in ("inner", "left", "left_outer"):
        raise ValueError("salted_join supports inner and left joins")
    keys = [on] if isinstance(on, str) else list(on)
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]), F.lit(buckets))
    b = big.withColumn("_fl_salt", salt)
    s = small.withColumn("_fl_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))
    return b.join(s, on=keys + ["_fl_salt"], how=how).drop("_fl_salt")
