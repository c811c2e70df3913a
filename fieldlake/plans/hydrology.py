"""Flow models: daily features (M18 core), water-year summary (M19),
gage dimension (M12 non-geometric part)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import MIN_DAYS_OF_RECORD, RIVER_PATTERNS
from ..functions.shape import classify_contains, water_year
from ..operators.aggregates import annual_volume_af, exact_percentiles, rb_flashiness
from ..operators.windows import rank_within, series_features


def _round(c: Column, digits):
    return c if digits is None else F.round(c, digits)


def daily_features(staged: DataFrame, entity: str = "gage_id", date: str = "flow_date",
                   value: str = "discharge_cfs", change_alias: str = "change_cfs",
                   segment: Column | None = None) -> DataFrame:
    """M18 core: previous value, day-over-day change and centred 7-row mean
    per gage, computed on the full staged series (N7), lag partitioned by gage
    only so the cross-year step counts (N17)."""
    out = series_features(staged, entity, [date], value, prev_alias=f"prev_{value}",
                          change_alias=change_alias,
                          rolling_alias="rolling_7d_mean_cfs", before=3, after=3, segment=segment)
    if "water_year" not in staged.columns:
        out = out.withColumn("water_year", water_year(F.col(date)))
    return out


def water_year_summary(daily: DataFrame, entity_cols=("gage_id",), value: str = "discharge_cfs",
                       change: str = "change_cfs", year_col: str = "water_year",
                       min_days: int = MIN_DAYS_OF_RECORD, digits: int | None = 1,
                       flash_digits: int | None = 4, volume_digits: int | None = 0) -> DataFrame:
    """One row per entity x water year.  Count, mean/min/max, exact
    median/p10/p90, Σ|change|, ΣQ, annual volume (acre-feet), then the
    completeness filter (before the rank, N9), flashiness and wettest rank."""
    keys = list(entity_cols) + [year_col]
    v = F.col(value)
    extra = {"days_of_record": F.count(F.lit(1)), "mean_cfs": _round(F.avg(v), digits),
             "min_cfs": _round(F.min(v), digits), "max_cfs": _round(F.max(v), digits),
             "sum_abs_change": F.sum(F.abs(F.col(change))), "sum_discharge": F.sum(v),
             "annual_volume_af": _round(annual_volume_af(F.sum(v)), volume_digits)}
    # one pass gives the plain aggregates and the percentile sketch together
    both = exact_percentiles(daily, keys, value, {"median_cfs": 0.5, "p10_cfs": 0.1, "p90_cfs": 0.9},
                             extra=extra)
    out = (both.withColumn("median_cfs", _round(F.col("median_cfs"), digits))
               .withColumn("p10_cfs", _round(F.col("p10_cfs"), digits))
               .withColumn("p90_cfs", _round(F.col("p90_cfs"), digits))
               .filter(F.col("days_of_record") >= min_days)
               .withColumn("rb_flashiness_index",
                           _round(rb_flashiness("sum_abs_change", "sum_discharge"), flash_digits)))
    return rank_within(out, list(entity_cols), "annual_volume_af", alias="wettest_year_rank")


def river_system(name_col) -> Column:
    """P8 on gage names."""
    return classify_contains(name_col, RIVER_PATTERNS)
