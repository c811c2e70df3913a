"""Documented analyses D1-D14 over the silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.shape import safe_pct
from ..operators import spatial
from ..operators.joins import attach_scalar
from ..operators.aggregates import corr_leave_one_out, count_when, ratio_summary, share_of_parent
from ..operators.windows import around_event, series_features, top_steps


def diurnal_profile(readings: DataFrame, entity: str, ts: str, value: str, tz: str = "America/Los_Angeles") -> DataFrame:
    """Mean by local hour of day and the amplitude as ± % of the daily mean."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col(ts))
    hourly = readings.groupBy(entity, F.hour(local).alias("local_hour")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value"))
    w = W.partitionBy(entity)
    amp = (F.max("mean_value").over(w) - F.min("mean_value").over(w)) / 2 / F.avg("mean_value").over(w) * 100
    return hourly.withColumn("amplitude_pct", amp)


def anomalous_hour_dates(readings: DataFrame, entity: str, ts: str, value: str, hour: int,
                         tz: str = "America/Los_Angeles") -> DataFrame:
    """Which local dates contribute to one hour's mean."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), F.col(ts))
    return (readings.filter(F.hour(local) == hour)
                    .groupBy(entity, F.to_date(local).alias("local_day"))
                    .agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value")))


def _steps(readings, entity, ts, value, order, segment):
    order = list(order) if order else [ts]
    return series_features(readings, entity, order, value, prev_alias="prev_value", change_alias="change",
                           rolling_alias=None, segment=segment)


def jumps(readings: DataFrame, entity: str, ts: str, value: str, k: int = 20, segment=None,
          order=None, tiebreak=None) -> DataFrame:
    """The k sharpest single steps (NULL lags removed first).
    ``order`` must be total within an entity (default: the timestamp);
    ``tiebreak`` orders equal steps (default: entity, time)."""
    s = _steps(readings, entity, ts, value, order, segment)
    return top_steps(s, "change", k, tiebreak or [entity, ts])


def jumps_by_weekday(readings: DataFrame, entity: str, ts: str, value: str, threshold: float, segment=None,
                     order=None) -> DataFrame:
    """D3: count of steps of at least ``threshold`` per weekday."""
    s = _steps(readings, entity, ts, value, order, segment)
    return (s.filter(F.abs("change") >= threshold).groupBy(F.dayname(ts).alias("weekday"))
             .agg(F.count(F.lit(1)).alias("n_jumps")))


def shape_around_biggest_jump(readings: DataFrame, entity: str, ts: str, value: str, hours: int = 2,
                              segment=None, order=None, tiebreak=None) -> DataFrame:
    """Raw rows of the entity within ±hours of its largest step."""
    top = jumps(readings, entity, ts, value, 1, segment, order, tiebreak).select(entity, F.col(ts).alias("event_time"))
    span = F.make_dt_interval(F.lit(0), F.lit(hours))
    return around_event(readings, top, entity, ts, span, span)


def size_vs_flashiness(summary: DataFrame, gages: DataFrame) -> DataFrame:
    """corr(ln basin area, mean flashiness) across gages, with each gage left out."""
    per = summary.groupBy("gage_id").agg(F.avg("rb_flashiness_index").alias("flashiness"))
    j = per.join(gages.select("gage_id", F.ln("basin_area_sqmi").alias("log_area")), "gage_id")
    return corr_leave_one_out(j, "gage_id", "log_area", "flashiness")


def owner_summary(profile: DataFrame) -> DataFrame:
    """D6 + D8: plots, mean live biomass, dead share by stems and by biomass, sawtimber."""
    return (profile.groupBy("owner_group").agg(
        F.count(F.lit(1)).alias("plots"), F.avg("live_biomass_tons_per_acre").alias("mean_live_biomass"),
        F.avg("dead_biomass_tons_per_acre").alias("mean_dead_biomass"),
        safe_pct(F.sum("dead_trees"), F.sum("trees_tallied")).alias("pct_dead_by_stems"),
        safe_pct(F.sum("dead_biomass_tons_per_acre"),
                 F.sum("dead_biomass_tons_per_acre") + F.sum("live_biomass_tons_per_acre")).alias("pct_dead_by_biomass"),
        F.avg("sawtimber_stems").alias("mean_sawtimber_stems")))


def stage_counts(profile: DataFrame) -> DataFrame:
    """Stand-stage counts by owner."""
    return profile.groupBy("owner_group", "stand_stage").agg(F.count(F.lit(1)).alias("plots"))


def genus_rollup(mortality_trees: DataFrame, species: DataFrame) -> DataFrame:
    """Dead share by genus (live/dead trees joined to the species genus)."""
    t = mortality_trees.filter(F.col("statuscd").isin(1, 2)).join(
        species.select(F.col("species_code"), "genus"), "species_code", "left")
    return (t.groupBy("genus").agg(F.count(F.lit(1)).alias("total_trees"),
                                   count_when(F.col("statuscd") == 2).alias("dead_trees"))
             .withColumn("pct_dead", safe_pct("dead_trees", "total_trees")))


def fire_effect_by_size(change: DataFrame) -> DataFrame:
    """Mean dead share before/after plus ratio of totals, mean and median
    of ratios of live biomass per size class (N16: all three reported)."""
    means = change.groupBy("size_class").agg(F.count(F.lit(1)).alias("pairs"),
                                             F.avg("pre_pct_dead").alias("mean_pre_pct_dead"),
                                             F.avg("post_pct_dead").alias("mean_post_pct_dead"))
    ratios = ratio_summary(change, ["size_class"], "pre_live_biomass", "post_live_biomass")
    return means.join(ratios, "size_class", "left")


def burn_counts(history: DataFrame, change: DataFrame) -> DataFrame:
    """Matches, distinct burned plots, paired plots."""
    h = history.agg(F.count(F.lit(1)).alias("matches"), F.count_distinct("plot_number").alias("burned_plots"))
    c = change.agg(F.count_distinct("plot_number").alias("paired_plots"))
    return attach_scalar(h, c)  # two single-row aggregates


def lake_coverage(lakes: DataFrame, measurements: DataFrame) -> DataFrame:
    """Every lake with its measurement count and share of all rows."""
    n = measurements.groupBy("lake_id").agg(F.count(F.lit(1)).alias("n_rows"))
    j = lakes.select("lake_id", "lake_name").join(n, "lake_id", "left").withColumn(
        "n_rows", F.coalesce("n_rows", F.lit(0).cast("long")))
    return share_of_parent(j, [], "n_rows", "pct_of_rows")


def growth_table(growth_by_site: DataFrame, species_name: str | None = None) -> DataFrame:
    """Growth by species, elevation and owner (optionally one species)."""
    g = growth_by_site if species_name is None else growth_by_site.filter(F.col("species_name") == species_name)
    return g.select("species_name", "elevation_band", "owner_group", "remeasured_trees",
                    "mean_annual_growth_in", "median_annual_growth_in")


def fires_by_basin(basins: DataFrame, fires: DataFrame, max_error: float = 0.5) -> DataFrame:
    """Share of each gage basin burned, within ``max_error`` percentage points."""
    out = spatial.overlap_within(basins, fires, "gage_id", "basin_geom", "fire_geom", max_error=max_error)
    return out.select("gage_id", "pct_burned", "error_bound")
