"""The declared data-quality suite (Q1-Q11) per model, singular rules, and
source freshness, run with ``operators.quality``.

``suite(models)`` takes whichever built models are at hand (name ->
DataFrame) and returns one report: per model, single-column checks are
folded into one aggregation pass; unique / relationships add one shuffle
each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..constants import BASIN_AREA_TOLERANCE, CHLOROPHYLL_RANGE, FIRE_YEAR_RANGE, FRESHNESS_ERROR_DAYS, FRESHNESS_WARN_DAYS
from ..functions import geo
from ..operators import quality as Q

# ---- FIXED VALUES: accepted values and ranges declared for the models ------
UNIT_CODES = ["deg C", "ug/L", "mg/L", "m", "RFU", "NTU", "ppb"]
WOOD_TYPES = ["Softwood", "Hardwood"]
ELEVATION_BAND_VALUES = ["Lowland (<1000 ft)", "Montane (1000-3000 ft)", "Upper montane (3000-5000 ft)",
                         "Subalpine (>5000 ft)"]
TREE_STATUS_VALUES = ["Live", "Dead", "Removed", "No status", "Unknown"]
SIZE_CLASS_VALUES = ["Megafire (100k+ ac)", "Large (10k-100k ac)", "Moderate (1k-10k ac)", "Small (100-1k ac)",
                     "Minor (<100 ac)"]
RIVER_SYSTEM_VALUES = ["Merced", "Tuolumne", "Stanislaus", "Other"]
STREAMFLOW_UNITS = ["cfs", "ft", "degC"]
LAKE_LAT_RANGE, LAKE_LON_RANGE = (32, 50), (-125, -114)
BASIN_AREA_RANGE = (0, 2000)
FLASHINESS_RANGE = (0, 5)
PCT_DEAD_RANGE = (0, 100)
MEAN_GROWTH_RANGE = (-0.5, 2)
TREE_DIAMETER_RANGE, TREE_MAX_HEIGHT_FT = (0, 200), 400


def _key(col):
    return [Q.unique(col), Q.not_null(col)]


def model_checks(name: str, parents: dict | None = None) -> list:
    """Checks declared for one model.  ``parents`` supplies the parent tables
    of relationship checks (e.g. {"dim_lakes": df})."""
    p = parents or {}

    def rel(col, parent, field):
        return [Q.relationships(col, p[parent], field)] if parent in p else []

    table = {
        "stg_wqp_results": [Q.not_null("measurement_sk"), Q.not_null("lake_id"), Q.not_null("sample_date")],
        "dim_lakes": _key("lake_id") + [Q.accepted_range("latitude", *LAKE_LAT_RANGE),
                                        Q.accepted_range("longitude", *LAKE_LON_RANGE)],
        "fct_lake_measurements": _key("measurement_sk") + [Q.not_null("lake_id"), Q.not_null("sample_date"),
                                                           Q.accepted_values("unit_code", UNIT_CODES, "warn")]
        + rel("lake_id", "dim_lakes", "lake_id"),
        "stg_streamflow": [Q.not_null("reading_sk"), Q.not_null("gage_id"), Q.not_null("reading_ts")],
        "dim_gages": _key("gage_id"),
        "fct_streamflow": _key("reading_sk") + [Q.not_null("gage_id"), Q.not_null("reading_ts"),
                                                Q.accepted_values("unit", STREAMFLOW_UNITS)]
        + rel("gage_id", "dim_gages", "gage_id"),
        "stg_sierra_gages": _key("gage_id"),
        "stg_sierra_daily_flow": _key("flow_sk") + [Q.not_null("gage_id"), Q.not_null("water_year")],
        "dim_sierra_gages": _key("gage_id") + [Q.accepted_values("river_system", RIVER_SYSTEM_VALUES),
                                               Q.accepted_range("basin_area_sqmi", *BASIN_AREA_RANGE)],
        "fct_sierra_daily_flow": _key("flow_sk") + [Q.not_null("gage_id")]
        + rel("gage_id", "dim_sierra_gages", "gage_id"),
        "fct_water_year_summary": [Q.not_null("water_year"), Q.accepted_range("rb_flashiness_index", *FLASHINESS_RANGE)],
        "stg_derived_streams": _key("segment_id"),
        "fct_gage_stream_validation": [Q.not_null("distance_m")],
        "stg_fia_plot": _key("plot_cn"),
        "stg_fia_cond": _key("cond_cn") + [Q.not_null("plot_cn")],
        "stg_fia_tree": _key("tree_cn") + [Q.not_null("plot_cn")],
        "dim_fia_species": _key("species_code") + [Q.accepted_values("wood_type", WOOD_TYPES)],
        "dim_fia_plot": _key("plot_cn") + [Q.accepted_values("elevation_band", ELEVATION_BAND_VALUES)],
        "fct_fia_tree": _key("tree_cn") + [Q.not_null("plot_cn"), Q.accepted_values("tree_status", TREE_STATUS_VALUES)]
        + rel("plot_cn", "dim_fia_plot", "plot_cn"),
        "fct_plot_timber_profile": _key("plot_cn") + [Q.accepted_range("pct_dead", *PCT_DEAD_RANGE)],
        "fct_growth_by_site": [Q.accepted_range("mean_annual_growth_in", *MEAN_GROWTH_RANGE)],
        "stg_wa_fires": _key("object_id") + [Q.not_null("fire_year"), Q.accepted_range("fire_year", *FIRE_YEAR_RANGE)],
        "dim_wa_fires": _key("fire_id") + [Q.accepted_values("size_class", SIZE_CLASS_VALUES)],
        "seed_lakes": _key("lake_id"),
        "seed_gages": _key("gage_id"),
    }
    return table.get(name, [])


# ---- singular rules (zero rows = pass) -------------------------------------------------
def impossible_chlorophyll(measurements: DataFrame) -> DataFrame:
    """Q6: chlorophyll results outside 0..500."""
    lo, hi = CHLOROPHYLL_RANGE
    return (measurements.filter(F.col("characteristic").ilike("%chlorophyll%")
                                & ((F.col("result_value") < lo) | (F.col("result_value") > hi)))
                        .select("measurement_sk", "station_id", "sample_date", "result_value", "unit_code"))


def basin_area_mismatch(gages: DataFrame, tolerance: float = BASIN_AREA_TOLERANCE) -> DataFrame:
    """Polygon area differs from the published drainage area by more than ``tolerance``."""
    pub, comp = F.col("usgs_drainage_area_sqmi"), F.col("basin_area_sqmi")
    return (gages.filter(pub.isNotNull() & (pub > 0) & (F.abs(comp - pub) / pub > tolerance))
                 .select("gage_id", "gage_name", "usgs_drainage_area_sqmi", "basin_area_sqmi",
                         (F.abs(comp - pub) / F.nullif(pub, F.lit(0))).alias("pct_diff")))


def invalid_stream_geometry(streams: DataFrame, geom_col: str = "geom") -> DataFrame:
    """Segments whose geometry is not valid (with the reason)."""
    return streams.withColumn("reason", geo.validity_reason(geom_col)).filter(F.col("reason").isNotNull())


def implausible_trees(trees: DataFrame) -> DataFrame:
    """Q9: diameter outside 0..200 in or height above 400 ft (run as a test)."""
    lo, hi = TREE_DIAMETER_RANGE
    return (trees.filter((F.col("diameter_in") > hi) | (F.col("diameter_in") < lo) | (F.col("height_ft") > TREE_MAX_HEIGHT_FT))
                 .select("tree_cn", "species_name", "diameter_in", "height_ft", "elevation_ft"))


SINGULAR = {"assert_no_impossible_chlorophyll": ("fct_lake_measurements", impossible_chlorophyll),
            "assert_basin_area_matches_usgs": ("dim_sierra_gages", basin_area_mismatch),
            "assert_derived_streams_valid_geometry": ("stg_derived_streams", invalid_stream_geometry),
            "assert_tree_diameter_plausible": ("fct_fia_tree", implausible_trees)}


def suite(models: dict, parents: dict | None = None) -> DataFrame:
    """Q11: the whole report for the given built models (name -> DataFrame):
    generic checks per model plus the singular rules whose model is present."""
    parents = {**models, **(parents or {})}
    parts = []
    for name, df in models.items():
        checks = model_checks(name, parents)
        if checks:
            parts.append(Q.run_checks(df, checks, table=name))
    for rule, (model, fn) in SINGULAR.items():
        if model in models:
            n = fn(models[model]).agg(F.count(F.lit(1)).cast("long").alias("failing_rows"))
            parts.append(n.select(F.lit(model).alias("table_name"), F.lit(rule).alias("check_name"),
                                  F.lit("singular").alias("kind"), F.lit("error").alias("severity"), "failing_rows",
                                  F.when(F.col("failing_rows") == 0, "pass").otherwise("fail").alias("status")))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


def source_freshness(sources: dict, now) -> DataFrame:
    """Q10: freshness of each raw source on ``_loaded_at`` (warn 4 days,
    error 8 days); pass only sources where freshness is on."""
    parts = [Q.freshness(df, "_loaded_at", now, FRESHNESS_WARN_DAYS, FRESHNESS_ERROR_DAYS, source=name)
             for name, df in sources.items()]
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out
