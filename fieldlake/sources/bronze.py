"""Loaders of the static bronze tables (S3, S5, S8 with the coercions of P15).

Each returns a DataFrame with the bronze table's schema; the command line
replaces the stored table with it and prints the load audit (S14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions import geo
from .geojson import property_of, read_geojson
from .typed import read_typed_csv


def _conform(df: DataFrame, schema) -> DataFrame:
    """The schema's columns in order; a column the file lacks is NULL."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def fia_table(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Forest inventory CSV (``plot``, ``cond`` or ``tree``): ids stay strings, empty fields are NULL."""
    return _conform(read_typed_csv(spark, path, schemas.FIA_SPECS[kind]), schemas.FIA_SPECS[kind])


def _text(*names: str) -> Column:
    return F.coalesce(property_of("properties", names), F.lit(""))


def _whole(*names: str) -> Column:
    """Integer property; 0, missing and unparsable are NULL."""
    return F.nullif(property_of("properties", names, "double").try_cast("int"), F.lit(0))


def fire_perimeters(spark: SparkSession, path: str) -> DataFrame:
    """Fire perimeter GeoJSON: missing acres count 0 and unparsable ones NULL,
    year 0 or unparsable is NULL, other text is '' where missing; rings with
    repeated or unclosed vertices are repaired."""
    f = read_geojson(spark, path)
    acres = F.when(property_of("properties", ["GIS_ACRES"]).isNull(), 0.0).otherwise(property_of("properties", ["GIS_ACRES"], "double"))
    f = f.withColumn("_g", geo.parse_wkt("geom_wkt"))
    # what repair changes is written anew; no edge is compared with all others for that
    f = f.withColumn("_r", geo.repair("_g")).withColumn("_w", F.when(F.col("_r") != F.col("_g"), geo.as_wkt("_r")).otherwise(F.col("geom_wkt")))
    return _conform(f.select(
        property_of("properties", ["OBJECTID"]).alias("object_id"), _text("INCIDENT").alias("incident_name"),
        _whole("FIRE_YEAR_INT").alias("fire_year"), _text("FIRE_YEAR").alias("fire_year_raw"), acres.alias("gis_acres"),
        _text("AGENCY").alias("agency"), _text("SOURCE").alias("source"), _text("FEATURE_CA").alias("feature_cat"),
        _text("UNQE_FIRE_ID").alias("unique_fire_id"), F.col("_w").alias("geom_wkt")), schemas.WA_FIRES)


def gage_basins(spark: SparkSession, path: str) -> DataFrame:
    """Gages with their basin polygon as GeoJSON; an unparsable number is NULL."""
    number = lambda n: property_of("properties", [n], "double").alias(n)
    return _conform(read_geojson(spark, path).select(
        property_of("properties", ["gage_id"]).alias("gage_id"), property_of("properties", ["gage_name"]).alias("gage_name"),
        number("latitude"), number("longitude"), number("drainage_area"), F.col("geom_wkt").alias("basin_wkt")), schemas.SIERRA_GAGES)


def derived_streams(spark: SparkSession, path: str) -> DataFrame:
    """Stream segments as GeoJSON in degrees."""
    return _conform(read_geojson(spark, path).select(
        property_of("properties", ["cat"], "int").alias("segment_id"), property_of("properties", ["stream_type"]).alias("stream_type"),
        property_of("properties", ["network"], "int").alias("network"), "geom_wkt"), schemas.DERIVED_STREAMS)


#: bronze table -> loader(spark, path)
LOADERS = {
    "fia_wa_plot_raw": lambda spark, path: fia_table(spark, path, "plot"),
    "fia_wa_cond_raw": lambda spark, path: fia_table(spark, path, "cond"),
    "fia_wa_tree_raw": lambda spark, path: fia_table(spark, path, "tree"),
    "wa_fire_perimeters_raw": fire_perimeters,
    "sierra_gages_raw": gage_basins,
    "derived_streams_raw": derived_streams,
}
