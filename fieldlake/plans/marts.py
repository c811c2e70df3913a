"""Dimension and fact models M10-M30 (silver layer) as DataFrame functions.

Incremental facts take the current ``target`` (None = first run / full
refresh) and return the new table; writing it is the caller's choice
(``incremental.merge_into_path`` for partition-scoped rewrites).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..constants import (DIAMETER_CLASSES, ELEVATION_BANDS, FIRE_JOIN_MIN_YEAR, FIRE_SIZE_CLASSES, GAGE_POINT,
                         GROWTH_DIAMETER_RANGE, GROWTH_INTERVAL_YEARS, GROWTH_MIN_TREES, LOOKBACK_DAYS,
                         MORTALITY_MIN_TREES, SAWTIMBER_MIN_DIAMETER_IN, STAND_STAGES, STAND_STAGE_NULL, WOOD_TYPE)
from ..functions import geo
from ..functions.shape import (bin_at_least, bin_below, decade, decode, lb_to_tons, safe_pct, sq_m_to_sq_miles,
                               timing_label)
from ..operators import dedup, incremental, spatial
from ..operators.aggregates import avg_when, count_when, exact_percentiles, group_mode, max_when, share_of_parent
from ..operators.joins import attach_scalar
from ..operators.windows import row_window
from .hydrology import daily_features, river_system, water_year_summary  # noqa: F401


# ---- dimensions ----------------------------------------------------------------------
def dim_lakes(seed: DataFrame) -> DataFrame:
    """M10."""
    return seed.select("lake_id", "lake_name", "mountain_range", "state_code", "elevation_ft", "latitude", "longitude")


def dim_gages(seed: DataFrame) -> DataFrame:
    """M11."""
    return seed.select("gage_id", "gage_name", "river", "mountain_range", "state_code", "role")


def dim_sierra_gages(stg: DataFrame) -> DataFrame:
    """River system from the name, basin area (mi²) and perimeter (km)
    from the polygon, Gravelius compactness."""
    g = stg.withColumn("_a", geo.area_m2("basin_geom")).withColumn("_p", geo.length_m("basin_geom"))
    return g.select("gage_id", "gage_name", river_system("gage_name").alias("river_system"), "latitude",
                    "longitude", "gage_point", "basin_geom", "usgs_drainage_area_sqmi",
                    sq_m_to_sq_miles("_a").alias("basin_area_sqmi"), (F.col("_p") / 1000.0).alias("basin_perimeter_km"),
                    geo.compactness("_p", "_a").alias("compactness_ratio"))


def dim_fia_species(seed: DataFrame) -> DataFrame:
    """NULL-propagating scientific name, wood type decode (no else)."""
    return seed.select(F.col("SPCD").alias("species_code"), F.col("COMMON_NAME").alias("common_name"),
                       F.col("GENUS").alias("genus"), F.col("SPECIES").alias("species_epithet"),
                       F.concat("GENUS", F.lit(" "), "SPECIES").alias("scientific_name"),
                       F.col("SPECIES_SYMBOL").alias("species_symbol"),
                       decode("SFTWD_HRDWD", WOOD_TYPE).alias("wood_type"))


def dim_fia_plot(plots: DataFrame, conds: DataFrame, elevation_null_label: str | None = None) -> DataFrame:
    """Plot visit + its dominant condition (largest proportion, NULL
    last, ties to the lower condition id) + elevation band (NULL -> the else
    band unless ``elevation_null_label``, N5)."""
    dom = dedup.dominant_child(conds, "plot_cn", "condition_proportion", ["condition_id", "cond_cn"])
    c = dom.select("plot_cn", "condition_status", "forest_type_code", "stand_age_years", "owner_group",
                   "slope_pct", "aspect_deg")
    p = plots.select("plot_cn", "plot_number", "countycd", "inventory_year", "measurement_year", "plot_status",
                     "latitude", "longitude", "elevation_ft", "plot_geom")
    return (p.join(c, "plot_cn", "left")
             .withColumn("elevation_band", bin_below("elevation_ft", ELEVATION_BANDS, null_label=elevation_null_label)))


def dim_wa_fires(stg: DataFrame) -> DataFrame:
    """Size class and decade."""
    return stg.select(F.col("object_id").alias("fire_id"), "incident_name", "fire_year",
                      F.col("gis_acres").alias("reported_acres"), "computed_acres", "agency", "data_source",
                      "fire_geom", bin_at_least("gis_acres", FIRE_SIZE_CLASSES).alias("size_class"),
                      decade("fire_year").alias("decade"))


# ---- incremental facts -----------------------------------------------------------------------
def fct_lake_measurements(stg: DataFrame, lakes: DataFrame, target: DataFrame | None = None,
                          lookback_days: int = LOOKBACK_DAYS["lake_measurements"]) -> DataFrame:
    """Lookback on load time (N19), scoped to watch-list lakes, non-detect flag, upsert."""
    inc = incremental.lookback_filter(stg, target, "_loaded_at", lookback_days)
    d = lakes.select("lake_id", "lake_name", "mountain_range")
    j = inc.join(d, "lake_id", "inner")
    out = j.select("measurement_sk", "lake_id", "station_id", "lake_name", "mountain_range", "sample_date",
                   "characteristic", "result_value", "unit_code", "detection_condition",
                   F.col("detection_condition").isNotNull().alias("is_non_detect"), "_loaded_at", "_batch_id")
    return incremental.merge_upsert(target, out, "measurement_sk")


def fct_streamflow(stg: DataFrame, gages: DataFrame, target: DataFrame | None = None,
                   lookback_days: int = LOOKBACK_DAYS["streamflow"]) -> DataFrame:
    """M17."""
    inc = incremental.lookback_filter(stg, target, "_loaded_at", lookback_days)
    d = gages.select("gage_id", "gage_name", "river", "mountain_range", "role")
    j = inc.join(d, "gage_id", "inner")
    return incremental.merge_upsert(target, j, "reading_sk")


def fct_sierra_daily_flow(stg: DataFrame, gages: DataFrame, target: DataFrame | None = None,
                          lookback_days: int = LOOKBACK_DAYS["daily_flow"], segment=None) -> DataFrame:
    """Lag, change and 7-row centred mean computed on the FULL staged
    series (N7), then only rows in the lookback window -- and the rows within
    three positions of one, whose rolling mean they change -- are upserted.
    Incremental == full refresh by construction."""
    feat = daily_features(stg, segment=segment if segment is not None else None)
    wm = incremental.watermark(target, "_loaded_at", lookback_days)
    if wm is not None:
        is_new = (F.col("_loaded_at") > incremental.literal_of(wm, "timestamp_ntz")).cast("int")
        feat = feat.withColumn("_new", is_new)
        feat = row_window(feat, "gage_id", ["flow_date"],
                          lambda w: {"_touch": F.max("_new").over(w.rowsBetween(-3, 3))}, 3, segment)
        feat = feat.filter(F.col("_touch") == 1).drop("_new", "_touch")
    d = gages.select("gage_id", "river_system", "gage_name")
    j = feat.join(d, "gage_id", "inner")
    return incremental.merge_upsert(target, j, "flow_sk")


def fct_water_year_summary(daily: DataFrame, min_days: int = 300) -> DataFrame:
    """M19 (keyed by gage with its name and river system)."""
    return water_year_summary(daily, ["gage_id", "gage_name", "river_system"], min_days=min_days)


def fct_gage_stream_validation(spark: SparkSession, streams: DataFrame, gage=GAGE_POINT, cell: float = 0.05) -> DataFrame:
    """The surveyed gage (constant row) against every LiDAR segment;
    nearest segment and its distance via the grid search."""
    gid, gname, lon, lat = gage
    pt = spark.createDataFrame([(gid, gname, float(lon), float(lat))], "gage_id string, gage_name string, lon double, lat double")
    near = spatial.nearest_geometry(pt, streams.select("segment_id", "geom"), "gage_id", "segment_id",
                                    "lon", "lat", "geom", cell=cell)
    return (near.filter(F.col("segment_id").isNotNull()).join(pt.select("gage_id", "gage_name"), "gage_id")
                .join(streams.select("segment_id", "stream_type"), "segment_id")
                .select("gage_id", "gage_name", "segment_id", "stream_type", "distance_m"))


# ---- forest facts --------------------------------------------------------------------------------
def fct_fia_tree(trees: DataFrame, plots: DataFrame, species: DataFrame) -> DataFrame:
    """Trees with plot attributes (inner) and species (left) + diameter class."""
    p = plots.select("plot_cn", "elevation_ft", "elevation_band", "owner_group", "forest_type_code",
                     "stand_age_years", "plot_geom")
    s = species.select("species_code", F.col("common_name").alias("species_name"), "scientific_name", "wood_type")
    t = trees.select("tree_cn", "plot_cn", "previous_tree_cn", "inventory_year", "tree_status", "statuscd",
                     F.col("species_code").alias("_spcd"), "diameter_in", "height_ft", "total_age_years",
                     "crown_class", "trees_per_acre", "carbon_above_ground_lb", "dry_biomass_above_ground_lb")
    j = t.join(p, "plot_cn", "inner").join(s, F.col("_spcd") == s.species_code, "left")
    return (j.withColumn("diameter_class", bin_below("diameter_in", DIAMETER_CLASSES))
             .drop("_spcd"))


def fct_tree_growth(tree: DataFrame) -> DataFrame:
    """Live re-measured trees joined to their previous measurement
    (strictly earlier inventory), growth and annualised growth."""
    cur = tree.filter(F.col("previous_tree_cn").isNotNull() & (F.col("statuscd") == 1)
                      & F.col("diameter_in").isNotNull())
    prev = tree.filter(F.col("diameter_in").isNotNull()).select(
        F.col("tree_cn").alias("_prev_cn"), F.col("diameter_in").alias("prev_diameter_in"),
        F.col("height_ft").alias("prev_height_ft"), F.col("inventory_year").alias("prev_inventory_year"))
    j = cur.join(prev, cur.previous_tree_cn == prev._prev_cn, "inner").filter(
        F.col("inventory_year") > F.col("prev_inventory_year"))
    interval = F.col("inventory_year") - F.col("prev_inventory_year")
    growth = F.col("diameter_in") - F.col("prev_diameter_in")
    return j.select("tree_cn", "plot_cn", "species_name", "wood_type", "elevation_band", "owner_group", "crown_class",
                    "prev_inventory_year", "inventory_year", interval.alias("interval_years"), "prev_diameter_in",
                    "diameter_in", F.round(growth, 2).alias("diameter_growth_in"),
                    F.round(growth / F.nullif(interval, F.lit(0)), 3).alias("annual_diameter_growth_in"))


def fct_growth_by_site(growth: DataFrame, min_trees: int = GROWTH_MIN_TREES) -> DataFrame:
    """Normal re-measure cycle and plausible growth only; mean, exact
    median and p90 per site class; thin groups dropped."""
    lo, hi = GROWTH_INTERVAL_YEARS
    glo, ghi = GROWTH_DIAMETER_RANGE
    g = growth.filter(F.col("interval_years").between(lo, hi) & F.col("diameter_growth_in").between(glo, ghi))
    keys = ["species_name", "wood_type", "elevation_band", "owner_group", "crown_class"]
    both = exact_percentiles(g, keys, "annual_diameter_growth_in",
                             {"median_annual_growth_in": 0.5, "p90_annual_growth_in": 0.9},
                             extra={"remeasured_trees": F.count(F.lit(1)),
                                    "mean_annual_growth_in": F.round(F.avg("annual_diameter_growth_in"), 4),
                                    "mean_interval_years": F.round(F.avg("interval_years"), 1),
                                    "mean_starting_diameter_in": F.round(F.avg("prev_diameter_in"), 1)})
    return (both.filter(F.col("remeasured_trees") >= min_trees)
                .select(*keys, "remeasured_trees", "mean_annual_growth_in",
                        F.round("median_annual_growth_in", 4).alias("median_annual_growth_in"),
                        F.round("p90_annual_growth_in", 4).alias("p90_annual_growth_in"),
                        "mean_interval_years", "mean_starting_diameter_in"))


def fct_species_mortality(tree: DataFrame, min_trees: int = MORTALITY_MIN_TREES,
                          exclude_pattern: str | None = "%unknown%") -> DataFrame:
    """live/dead trees of known species; dead share; HAVING; ordered by
    share (only meaningful at read time)."""
    t = tree.filter(F.col("statuscd").isin(1, 2) & F.col("species_name").isNotNull())
    if exclude_pattern:
        t = t.filter(~F.col("species_name").ilike(exclude_pattern))
    dead = F.col("statuscd") == 2
    out = (t.groupBy("species_name", "wood_type", "elevation_band")
             .agg(F.count(F.lit(1)).alias("total_trees"), count_when(dead).alias("dead_trees"),
                  F.round(avg_when(F.col("statuscd") == 1, "diameter_in"), 1).alias("avg_live_diameter_in"),
                  F.round(avg_when(dead, "diameter_in"), 1).alias("avg_dead_diameter_in"))
             .filter(F.col("total_trees") >= min_trees)
             .withColumn("pct_dead", F.round(safe_pct("dead_trees", "total_trees"), 1)))
    return out.orderBy(F.col("pct_dead").desc_nulls_first())


def fct_stand_structure(tree: DataFrame) -> DataFrame:
    """Live trees by owner, elevation band and diameter class, with the
    class's share of stems within owner x band."""
    live = tree.filter((F.col("statuscd") == 1) & F.col("diameter_in").isNotNull() & F.col("owner_group").isNotNull())
    agg = (live.groupBy("owner_group", "elevation_band", "diameter_class")
               .agg(F.count(F.lit(1)).alias("tree_count"),
                    F.round(F.sum("trees_per_acre"), 1).alias("expanded_trees_per_acre"),
                    F.round(F.avg("diameter_in"), 1).alias("avg_diameter_in"),
                    F.round(F.avg("height_ft"), 1).alias("avg_height_ft"),
                    F.round(lb_to_tons(F.sum("dry_biomass_above_ground_lb")), 1).alias("biomass_tons")))
    out = share_of_parent(agg, ["owner_group", "elevation_band"], "tree_count", "pct_of_stems")
    return out.withColumn("pct_of_stems", F.round("pct_of_stems", 1))


def fct_plot_timber_profile(tree: DataFrame, plot_dim: DataFrame) -> DataFrame:
    """Per plot visit: tallies, dead share, per-acre live/dead biomass and
    carbon (expansion factor x pounds / 2000), live size stats, sawtimber
    stems, commonest live species; forest plots only; stand stage."""
    t = tree.filter(F.col("statuscd").isin(1, 2))
    live, dead = F.col("statuscd") == 1, F.col("statuscd") == 2
    agg = t.groupBy("plot_cn").agg(
        F.count(F.lit(1)).alias("trees_tallied"), count_when(live).alias("live_trees"),
        count_when(dead).alias("dead_trees"),
        F.round(F.sum(F.when(live, F.col("dry_biomass_above_ground_lb") * F.col("trees_per_acre"))) / 2000.0, 2)
        .alias("live_biomass_tons_per_acre"),
        F.round(F.sum(F.when(live, F.col("carbon_above_ground_lb") * F.col("trees_per_acre"))) / 2000.0, 2)
        .alias("live_carbon_tons_per_acre"),
        F.round(F.sum(F.when(dead, F.col("dry_biomass_above_ground_lb") * F.col("trees_per_acre"))) / 2000.0, 2)
        .alias("dead_biomass_tons_per_acre"),
        F.round(avg_when(live, "diameter_in"), 1).alias("avg_live_diameter_in"),
        F.round(max_when(live, "diameter_in"), 1).alias("max_live_diameter_in"),
        F.round(avg_when(live, "height_ft"), 1).alias("avg_live_height_ft"),
        count_when(live & (F.col("diameter_in") >= SAWTIMBER_MIN_DIAMETER_IN)).alias("sawtimber_stems"))
    agg = agg.withColumn("pct_dead", F.round(safe_pct("dead_trees", "trees_tallied"), 1))
    mode = group_mode(t.filter(live), ["plot_cn"], "species_name", alias="dominant_species")
    p = plot_dim.filter(F.col("condition_status") == "Forest").select(
        "plot_cn", "plot_number", "inventory_year", "measurement_year", "latitude", "longitude", "plot_geom",
        "elevation_ft", "elevation_band", "owner_group", "forest_type_code", "stand_age_years", "slope_pct")
    return (p.join(agg, "plot_cn", "inner").join(mode, "plot_cn", "left")
             .withColumn("stand_stage", bin_below("stand_age_years", STAND_STAGES, null_label=STAND_STAGE_NULL)))


def fct_plot_fire_history(profile: DataFrame, fires: DataFrame, min_fire_year: int = FIRE_JOIN_MIN_YEAR) -> DataFrame:
    """Plot visits inside fire perimeters (cell cover join), timing
    relative to the fire year."""
    p = profile.select("plot_cn", "plot_number", "measurement_year", "latitude", "longitude", "owner_group",
                       "elevation_band", "live_biomass_tons_per_acre", "dead_biomass_tons_per_acre",
                       "pct_dead", "live_trees", "dead_trees", "stand_age_years", "dominant_species")
    f = fires.filter(F.col("fire_year") >= min_fire_year).select(
        "fire_id", "incident_name", "fire_year", "reported_acres", "size_class", "fire_geom")
    j = spatial.spatial_join(p, f, "longitude", "latitude", "fire_geom", geom_id="fire_id")
    return (j.drop("fire_geom", "latitude", "longitude")
             .withColumn("years_since_fire", F.col("measurement_year") - F.col("fire_year"))
             .withColumn("measurement_timing", timing_label("measurement_year", "fire_year")))


def fct_burned_plot_change(history: DataFrame, plot_keys=("plot_number",)) -> DataFrame:
    """pre/post pivot by conditional max per plot x fire (grouped also by
    owner and band as written, N14), both sides required; changes and the
    NULL-guarded percent change.  ``plot_keys`` lets callers add countycd (N13)."""
    pre, post = F.col("measurement_timing") == "Pre-fire", F.col("measurement_timing") == "Post-fire"
    keys = list(plot_keys) + ["fire_id", "incident_name", "fire_year", "reported_acres", "size_class", "owner_group",
                              "elevation_band"]
    piv = history.groupBy(*keys).agg(
        max_when(pre, "measurement_year").alias("pre_year"), max_when(post, "measurement_year").alias("post_year"),
        max_when(pre, "live_biomass_tons_per_acre").alias("pre_live_biomass"),
        max_when(post, "live_biomass_tons_per_acre").alias("post_live_biomass"),
        max_when(pre, "pct_dead").alias("pre_pct_dead"), max_when(post, "pct_dead").alias("post_pct_dead"),
        max_when(pre, "live_trees").alias("pre_live_trees"), max_when(post, "live_trees").alias("post_live_trees"))
    bio = F.col("post_live_biomass") - F.col("pre_live_biomass")
    return (piv.filter(F.col("pre_year").isNotNull() & F.col("post_year").isNotNull())
               .withColumn("remeasure_interval", F.col("post_year") - F.col("pre_year"))
               .withColumn("biomass_change_tpa", F.round(bio, 2))
               .withColumn("pct_dead_change", F.round(F.col("post_pct_dead") - F.col("pre_pct_dead"), 1))
               .withColumn("live_tree_change", F.col("post_live_trees") - F.col("pre_live_trees"))
               .withColumn("pct_biomass_change", F.round(bio / F.nullif(F.col("pre_live_biomass"), F.lit(0)) * 100, 1)))


# ---- snapshot ----------------------------------------------------------------------------------------
def snap_monitoring_stations(raw: DataFrame, snapshot: DataFrame | None, as_of,
                             invalidate_hard_deletes: bool = True) -> DataFrame:
    """Station attributes from the variant payload; check strategy on
    name, latitude, longitude, huc8.  Bronze is append-only: the current
    stations are those of the latest load, a station absent from it is gone.
    A load that repeats a station counts once, first by name."""
    from ..functions.shape import variant_field
    from ..constants import WQP_STATION_KEYS as k
    types = {"latitude": "double", "longitude": "double"}
    latest = raw.agg(F.max("_loaded_at").alias("_latest_load"))
    raw = attach_scalar(raw, latest).filter(F.col("_loaded_at").eqNullSafe(F.col("_latest_load")))
    cur = raw.select(*[variant_field("payload", key, types.get(col, "string")).alias(col) for col, key in k.items()])
    cur = dedup.keep_first(cur, "station_id", "station_name", tiebreak=["latitude", "longitude", "huc8"])
    as_of_c = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    return incremental.scd2_check(snapshot, cur, "station_id", ["station_name", "latitude", "longitude", "huc8"],
                                  as_of_c, invalidate_hard_deletes)


# ---- exports (M30) -----------------------------------------------------------------------------------
def latest_plot_profile(profile: DataFrame, plot_keys=("plot_number",)) -> DataFrame:
    """Newest visit per plot (NULL year last)."""
    return dedup.keep_one(profile, list(plot_keys), [F.col("measurement_year").desc_nulls_last()], ["plot_cn"])


def burned_pairs_with_position(change: DataFrame, profile: DataFrame) -> DataFrame:
    """Burned pairs joined to a position per plot number (max lat / lon)."""
    pos = profile.groupBy("plot_number").agg(F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude"))
    return change.join(pos, "plot_number", "inner")


def large_modern_fires(fires: DataFrame, min_year: int = 2000, min_acres: float = 1000) -> DataFrame:
    return (fires.filter((F.col("fire_year") >= min_year) & (F.col("reported_acres") >= min_acres))
                 .select("fire_id", "incident_name", "fire_year", "reported_acres", "size_class",
                         geo.as_wkt("fire_geom").alias("geom_wkt")))


def burned_size_summary(pairs: DataFrame) -> DataFrame:
    """Burned pairs, mean change of biomass and of dead share per fire size class."""
    return class_summary(pairs, "size_class", {"mean_change": "biomass_change_tpa", "mean_dead_chg": "pct_dead_change"}).withColumnRenamed("n", "pairs")


def owner_summary(latest: DataFrame) -> DataFrame:
    """Plots, mean biomass and mean dead share per owner group."""
    return class_summary(latest, "owner_group", {"mean_biomass": "live_biomass_tons_per_acre", "mean_pct_dead": "pct_dead"}).withColumnRenamed("n", "plots")


def class_summary(df: DataFrame, class_col: str, measures: dict, digits: int | None = 1) -> DataFrame:
    """Count and means per class (NULL classes dropped, as pandas groupby does)."""
    def r(c):
        return c if digits is None else F.round(c, digits)
    return (df.filter(F.col(class_col).isNotNull()).groupBy(class_col)
              .agg(F.count(F.lit(1)).alias("n"), *[r(F.avg(c)).alias(a) for a, c in measures.items()]))
