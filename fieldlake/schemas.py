"""Explicit schemas of the bronze and seed tables (no inference: IDs stay strings)."""

from pyspark.sql import types as T

S, I, D, DT, TS, V = (T.StringType(), T.IntegerType(), T.DoubleType(), T.DateType(),
                      T.TimestampNTZType(), T.VariantType())


def struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_ENVELOPE = struct(("payload", V), ("_loaded_at", TS), ("_batch_id", S))

FIA_PLOT = struct(("cn", S), ("statecd", I), ("unitcd", I), ("countycd", I), ("plot", I), ("invyr", I),
                  ("measyear", I), ("plot_status_cd", I), ("lat", D), ("lon", D), ("elev", D))
FIA_COND = struct(("cn", S), ("plt_cn", S), ("invyr", I), ("condid", I), ("cond_status_cd", I), ("fortypcd", I),
                  ("stdage", I), ("owncd", I), ("owngrpcd", I), ("siteclcd", I), ("slope", I), ("aspect", I),
                  ("condprop_unadj", D))
FIA_TREE = struct(("cn", S), ("plt_cn", S), ("prev_tre_cn", S), ("condid", I), ("invyr", I), ("statuscd", I),
                  ("spcd", I), ("dia", D), ("ht", D), ("actualht", D), ("totage", D), ("tpa_unadj", D),
                  ("carbon_ag", D), ("drybio_ag", D), ("cclcd", I))
WA_FIRES = struct(("object_id", S), ("incident_name", S), ("fire_year", I), ("fire_year_raw", S),
                  ("gis_acres", D), ("agency", S), ("source", S), ("feature_cat", S), ("unique_fire_id", S),
                  ("geom_wkt", S))
SIERRA_GAGES = struct(("gage_id", S), ("gage_name", S), ("latitude", D), ("longitude", D),
                      ("drainage_area", D), ("basin_wkt", S))
DERIVED_STREAMS = struct(("segment_id", I), ("stream_type", S), ("network", I), ("geom_wkt", S))

SEED_LAKES = struct(("lake_id", S), ("lake_name", S), ("mountain_range", S), ("state_code", S),
                    ("elevation_ft", I), ("latitude", D), ("longitude", D))
SEED_GAGES = struct(("gage_id", S), ("gage_name", S), ("river", S), ("mountain_range", S), ("state_code", S),
                    ("role", S))
SEED_SIERRA_GAGES = struct(("gage_id", S), ("n_days", I), ("first_day", DT), ("last_day", DT))
SEED_FIA_SPECIES = struct(("SPCD", I), ("COMMON_NAME", S), ("GENUS", S), ("SPECIES", S), ("SPECIES_SYMBOL", S),
                          ("E_SPGRPCD", D), ("WOODLAND", S), ("SFTWD_HRDWD", S))

# Typed-CSV specs for the forest inventory loads (name -> Spark type), in the
# bronze column order; the raw CSVs carry upper-case headers.
FIA_SPECS = {"plot": FIA_PLOT, "cond": FIA_COND, "tree": FIA_TREE}
