"""Staging models M1-M9: bronze -> typed, keyed, deduplicated rows.

Each is a lazy DataFrame function (a "view"): Catalyst fuses it into
whatever consumes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..constants import (CONDITION_STATUS, CROWN_CLASS, FIRE_YEAR_RANGE, OWNER_GROUP, PLOT_STATUS, TREE_STATUS,
                         WQP_RESULT_KEYS, WQP_UNIT_KEYS)
from ..functions import geo
from ..functions.keys import surrogate_key
from ..functions.shape import (clean_name, decode, first_present, sq_m_to_acres, strip_float_suffix,
                               try_double, variant_field, water_year)
from ..operators import dedup


def _keep(df, key, keep: str, order: str, tiebreak):
    if keep == "first":
        return dedup.keep_first(df, key, order, tiebreak=tiebreak)
    return dedup.keep_last(df, key, order, tiebreak=tiebreak)


def stg_wqp_results(raw: DataFrame, keep: str = "first") -> DataFrame:
    """M1: lake chemistry results.  Non-numeric values ('<0.5') -> NULL, two
    unit keys coalesced, rows without lake or date dropped, one row per
    measurement key (earliest load wins; N2 ``keep='last'`` variant;
    remaining columns break ties, N3)."""
    p = "payload"
    k = WQP_RESULT_KEYS
    df = raw.select(
        variant_field(p, k["lake_id"]).alias("lake_id"),
        variant_field(p, k["station_id"]).alias("station_id"),
        variant_field(p, k["sample_date"], "date").alias("sample_date"),
        variant_field(p, k["characteristic"]).alias("characteristic"),
        try_double(variant_field(p, k["result_value"])).alias("result_value"),
        first_present(p, WQP_UNIT_KEYS).alias("unit_code"),
        variant_field(p, k["detection_condition"]).alias("detection_condition"),
        "_loaded_at", "_batch_id")
    df = df.filter(F.col("lake_id").isNotNull() & F.col("sample_date").isNotNull())
    df = df.withColumn("measurement_sk", surrogate_key("lake_id", "station_id", "sample_date", "characteristic",
                                                       "unit_code"))
    df = _keep(df, "measurement_sk", keep, "_loaded_at", ["result_value", "detection_condition", "_batch_id"])
    return df.select("measurement_sk", *[c for c in df.columns if c != "measurement_sk"])


def stg_streamflow(raw: DataFrame, keep: str = "first") -> DataFrame:
    """M2: continuous readings, one per (gage, parameter, timestamp)."""
    p = "payload"
    df = raw.select(
        variant_field(p, "gage_id").alias("gage_id"),
        variant_field(p, "parameter_code").alias("parameter_code"),
        variant_field(p, "unit").alias("unit"),
        variant_field(p, "datetime_utc", "timestamp_ntz").alias("reading_ts"),
        variant_field(p, "value", "double").alias("reading_value"),
        variant_field(p, "qualifier").alias("qualifier"),
        "_loaded_at", "_batch_id")
    df = df.filter(F.col("gage_id").isNotNull() & F.col("reading_ts").isNotNull())
    df = df.withColumn("reading_sk", surrogate_key("gage_id", "parameter_code", "reading_ts"))
    df = _keep(df, "reading_sk", keep, "_loaded_at", ["reading_value", "qualifier", "_batch_id"])
    return df.select("reading_sk", *[c for c in df.columns if c != "reading_sk"])


def stg_sierra_daily_flow(raw: DataFrame, keep: str = "last") -> DataFrame:
    """M3: daily discharge, one per (gage, day); latest load wins; water year."""
    p = "payload"
    df = raw.select(
        variant_field(p, "gage_id").alias("gage_id"),
        variant_field(p, "flow_date", "date").alias("flow_date"),
        variant_field(p, "discharge_cfs", "double").alias("discharge_cfs"),
        variant_field(p, "approval").alias("approval_status"),
        "_loaded_at", "_batch_id")
    df = df.filter(F.col("gage_id").isNotNull() & F.col("flow_date").isNotNull())
    df = (df.withColumn("flow_sk", surrogate_key("gage_id", "flow_date"))
            .withColumn("water_year", water_year("flow_date")))
    df = _keep(df, "flow_sk", keep, "_loaded_at", ["discharge_cfs", "approval_status", "_batch_id"])
    return df.select("flow_sk", "gage_id", "flow_date", "discharge_cfs", "approval_status", "water_year",
                     "_loaded_at", "_batch_id")


def stg_sierra_gages(raw: DataFrame) -> DataFrame:
    """M4: gage points and basin polygons."""
    return raw.select("gage_id", "gage_name", "latitude", "longitude",
                      F.col("drainage_area").alias("usgs_drainage_area_sqmi"),
                      geo.parse_wkt("basin_wkt").alias("basin_geom"),
                      geo.point("longitude", "latitude").alias("gage_point"))


def stg_derived_streams(raw: DataFrame, lines_only: bool = True) -> DataFrame:
    """M5: stream segments as geometry (P18: start-marker points dropped)."""
    df = raw.select("segment_id", "stream_type", "network", geo.parse_wkt("geom_wkt").alias("geom"))
    if lines_only:
        df = df.filter(F.col("geom.gtype").like("%LINESTRING"))
    return df


def stg_fia_plot(raw: DataFrame) -> DataFrame:
    """M6: plot visits with coordinates."""
    return (raw.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
               .select(F.col("cn").alias("plot_cn"), "statecd", "countycd", F.col("plot").alias("plot_number"),
                       F.col("invyr").alias("inventory_year"), F.col("measyear").alias("measurement_year"),
                       "plot_status_cd", decode("plot_status_cd", PLOT_STATUS).alias("plot_status"),
                       F.col("lat").alias("latitude"), F.col("lon").alias("longitude"),
                       F.col("elev").alias("elevation_ft"), geo.point("lon", "lat").alias("plot_geom")))


def stg_fia_cond(raw: DataFrame) -> DataFrame:
    """M7: conditions (parts of a plot)."""
    return raw.select(F.col("cn").alias("cond_cn"), F.col("plt_cn").alias("plot_cn"),
                      F.col("condid").alias("condition_id"), F.col("invyr").alias("inventory_year"),
                      "cond_status_cd", decode("cond_status_cd", CONDITION_STATUS).alias("condition_status"),
                      F.col("fortypcd").alias("forest_type_code"), F.col("stdage").alias("stand_age_years"),
                      F.col("owncd").alias("owner_code"), F.col("owngrpcd").alias("owner_group_code"),
                      decode("owngrpcd", OWNER_GROUP).alias("owner_group"),
                      F.col("siteclcd").alias("site_class_code"), F.col("slope").alias("slope_pct"),
                      F.col("aspect").alias("aspect_deg"), F.col("condprop_unadj").alias("condition_proportion"))


def stg_fia_tree(raw: DataFrame) -> DataFrame:
    """M8: tree measurements; predecessor pointer cleaned of a '.0' suffix."""
    return raw.select(F.col("cn").alias("tree_cn"), F.col("plt_cn").alias("plot_cn"),
                      strip_float_suffix("prev_tre_cn").alias("previous_tree_cn"),
                      F.col("condid").alias("condition_id"), F.col("invyr").alias("inventory_year"),
                      "statuscd", decode("statuscd", TREE_STATUS).alias("tree_status"),
                      F.col("spcd").alias("species_code"), F.col("dia").alias("diameter_in"),
                      F.col("ht").alias("height_ft"), F.col("actualht").alias("actual_height_ft"),
                      F.col("totage").alias("total_age_years"), F.col("tpa_unadj").alias("trees_per_acre"),
                      F.col("carbon_ag").alias("carbon_above_ground_lb"),
                      F.col("drybio_ag").alias("dry_biomass_above_ground_lb"),
                      F.col("cclcd").alias("crown_class_code"), decode("cclcd", CROWN_CLASS).alias("crown_class"))


def stg_wa_fires(raw: DataFrame, blank_name_uses_id: bool = False) -> DataFrame:
    """M9: fire perimeters.  Year sentinels and reconstructions dropped,
    names normalised, largest polygon per (year, name) kept (N6: unnamed fires
    of one year collapse unless ``blank_name_uses_id``), computed acres."""
    lo, hi = FIRE_YEAR_RANGE
    name = clean_name("incident_name")
    if blank_name_uses_id:
        name = F.when(F.coalesce(name, F.lit("")) == "", F.concat(F.lit("#"), F.col("object_id"))).otherwise(name)
    df = (raw.filter(F.col("fire_year").between(lo, hi) & (F.col("gis_acres") > 0) & F.col("geom_wkt").isNotNull())
             .select("object_id", name.alias("incident_name"), "fire_year", "gis_acres", "agency",
                     F.col("source").alias("data_source"), "feature_cat", "unique_fire_id",
                     geo.parse_wkt("geom_wkt").alias("fire_geom")))
    df = dedup.keep_largest(df, ["fire_year", "incident_name"], "gis_acres", tiebreak=["object_id"])
    return df.withColumn("computed_acres", F.round(sq_m_to_acres(geo.area_m2("fire_geom")), 1))
