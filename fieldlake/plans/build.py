"""Build every silver model from bronze and seeds in dependency order (the
``dbt build`` of the reference: seed + run + snapshot + test), I6.

Staging models stay lazy views; models several consumers read (the tree fact
and the plot profile) are written once and re-read; incremental facts merge
into their current targets when given.  Output tables are written with the
reference's clustering keys, into a folder of their build; one commit makes
them current (``sources.versions``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..session import table_exists
from ..sources import versions
from ..sources.tables import bucketed_table, clustered_write
from . import checks, marts, staging
from .hydrology import daily_features  # noqa: F401

# FIXED VALUES: clustering keys declared for the stored facts
CLUSTER_BY = {"fct_lake_measurements": ["sample_date"], "fct_streamflow": ["reading_ts"],
              "fct_sierra_daily_flow": ["flow_date"], "fct_fia_tree": ["inventory_year", "species_code"]}


def build_models(spark: SparkSession, bronze: dict, seeds: dict, targets: dict | None = None,
                 shared_root: str | None = None, min_days_of_record: int = 300) -> dict:
    """Return name -> DataFrame for every model whose inputs are present.

    bronze keys: wqp_results_raw, wqp_stations_raw, streamflow_continuous_raw,
    sierra_daily_flow_raw, sierra_gages_raw, derived_streams_raw,
    fia_wa_plot_raw, fia_wa_cond_raw, fia_wa_tree_raw, wa_fire_perimeters_raw.
    seeds keys: lakes, gages, fia_species.  ``targets``: current incremental
    tables / snapshot (None = full refresh).  ``shared_root``: folder where
    shared models are materialised (defaults to lazy)."""
    t = targets or {}
    m: dict[str, DataFrame] = {}

    def share(name, df):
        if shared_root:
            write_models({name: df}, shared_root)
            return spark.read.parquet(os.path.join(shared_root, name))
        return df

    if "lakes" in seeds:
        m["dim_lakes"] = marts.dim_lakes(seeds["lakes"])
    if "gages" in seeds:
        m["dim_gages"] = marts.dim_gages(seeds["gages"])
    if "fia_species" in seeds:
        m["dim_fia_species"] = marts.dim_fia_species(seeds["fia_species"])

    if "wqp_results_raw" in bronze:
        m["stg_wqp_results"] = staging.stg_wqp_results(bronze["wqp_results_raw"])
        if "dim_lakes" in m:
            m["fct_lake_measurements"] = marts.fct_lake_measurements(
                m["stg_wqp_results"], m["dim_lakes"], t.get("fct_lake_measurements"))
    if "wqp_stations_raw" in bronze and "as_of" in t:
        m["snap_monitoring_stations"] = marts.snap_monitoring_stations(
            bronze["wqp_stations_raw"], t.get("snap_monitoring_stations"), t["as_of"])
    if "streamflow_continuous_raw" in bronze:
        m["stg_streamflow"] = staging.stg_streamflow(bronze["streamflow_continuous_raw"])
        if "dim_gages" in m:
            m["fct_streamflow"] = marts.fct_streamflow(m["stg_streamflow"], m["dim_gages"], t.get("fct_streamflow"))
    if "sierra_gages_raw" in bronze:
        m["stg_sierra_gages"] = staging.stg_sierra_gages(bronze["sierra_gages_raw"])
        m["dim_sierra_gages"] = marts.dim_sierra_gages(m["stg_sierra_gages"])
    if "sierra_daily_flow_raw" in bronze:
        m["stg_sierra_daily_flow"] = staging.stg_sierra_daily_flow(bronze["sierra_daily_flow_raw"])
        if "dim_sierra_gages" in m:
            m["fct_sierra_daily_flow"] = share("fct_sierra_daily_flow", marts.fct_sierra_daily_flow(
                m["stg_sierra_daily_flow"], m["dim_sierra_gages"], t.get("fct_sierra_daily_flow")))
            m["fct_water_year_summary"] = marts.fct_water_year_summary(m["fct_sierra_daily_flow"], min_days_of_record)
    if "derived_streams_raw" in bronze:
        m["stg_derived_streams"] = staging.stg_derived_streams(bronze["derived_streams_raw"])
        m["fct_gage_stream_validation"] = marts.fct_gage_stream_validation(spark, m["stg_derived_streams"])

    if {"fia_wa_plot_raw", "fia_wa_cond_raw", "fia_wa_tree_raw"} <= set(bronze):
        m["stg_fia_plot"] = staging.stg_fia_plot(bronze["fia_wa_plot_raw"])
        m["stg_fia_cond"] = staging.stg_fia_cond(bronze["fia_wa_cond_raw"])
        m["stg_fia_tree"] = staging.stg_fia_tree(bronze["fia_wa_tree_raw"])
        m["dim_fia_plot"] = share("dim_fia_plot", marts.dim_fia_plot(m["stg_fia_plot"], m["stg_fia_cond"]))
        if "dim_fia_species" in m:
            tree = share("fct_fia_tree", marts.fct_fia_tree(m["stg_fia_tree"], m["dim_fia_plot"], m["dim_fia_species"]))
            m["fct_fia_tree"] = tree
            m["fct_tree_growth"] = share("fct_tree_growth", marts.fct_tree_growth(tree))
            m["fct_growth_by_site"] = marts.fct_growth_by_site(m["fct_tree_growth"])
            m["fct_species_mortality"] = marts.fct_species_mortality(tree)
            m["fct_stand_structure"] = marts.fct_stand_structure(tree)
            m["fct_plot_timber_profile"] = share("fct_plot_timber_profile",
                                                 marts.fct_plot_timber_profile(tree, m["dim_fia_plot"]))
    if "wa_fire_perimeters_raw" in bronze:
        m["stg_wa_fires"] = staging.stg_wa_fires(bronze["wa_fire_perimeters_raw"])
        m["dim_wa_fires"] = marts.dim_wa_fires(m["stg_wa_fires"])
        if "fct_plot_timber_profile" in m:
            m["fct_plot_fire_history"] = marts.fct_plot_fire_history(m["fct_plot_timber_profile"], m["dim_wa_fires"])
            m["fct_burned_plot_change"] = marts.fct_burned_plot_change(m["fct_plot_fire_history"])
    if seeds.get("lakes") is not None:
        m["seed_lakes"] = seeds["lakes"]
    if seeds.get("gages") is not None:
        m["seed_gages"] = seeds["gages"]
    return m


# tables re-joined / re-aggregated on the plot key: bucketing them the same
# way removes the shuffle from those joins when a catalog is available
BUCKET_BY = {"dim_fia_plot": ["plot_cn"], "fct_fia_tree": ["plot_cn"], "fct_plot_timber_profile": ["plot_cn"]}


def write_models(models: dict, out_root: str, names=None, catalog_db: str | None = None,
                 n_buckets: int = 64) -> None:
    """Write models as Parquet tables (clustered where declared); geometry
    structs are stored as they are (Parquet nested types).  With
    ``catalog_db`` the plot-keyed forest tables become catalog tables
    bucketed on ``plot_cn`` instead."""
    for name in names or models:
        if name.startswith(("stg_", "seed_")):
            continue
        path = os.path.join(out_root, name)
        df = models[name]
        if catalog_db and name in BUCKET_BY:
            bucketed_table(df, f"{catalog_db}.{name}", BUCKET_BY[name], n_buckets)
        elif name in CLUSTER_BY:
            clustered_write(df, path, CLUSTER_BY[name])
        else:
            df.write.mode("overwrite").parquet(path)


# models several consumers read: build_models writes them itself when it is given a folder
SHARED = ("fct_sierra_daily_flow", "dim_fia_plot", "fct_fia_tree", "fct_tree_growth", "fct_plot_timber_profile")

# models that take their stored version as the target of an incremental build
INCREMENTAL = ("fct_lake_measurements", "fct_streamflow", "fct_sierra_daily_flow", "snap_monitoring_stations")


def stored_targets(spark: SparkSession, out_root: str, incremental: bool = False, as_of: str | None = None) -> dict:
    """Targets of a build: the committed facts if ``incremental``; with
    ``as_of`` a snapshot run on the committed snapshot, which always grows.
    A table that lies under ``out_root`` without a commit is taken as it is."""
    names = [n for n in INCREMENTAL if (incremental and n.startswith("fct_")) or (as_of and n.startswith("snap_"))]
    at = {n: versions.table_path(spark, out_root, n) or os.path.join(out_root, n) for n in names}
    targets = {n: spark.read.parquet(p) for n, p in at.items() if table_exists(spark, p)}
    return targets | ({"as_of": as_of} if as_of else {})


def build(spark: SparkSession, bronze: dict, seeds: dict, out_root: str, targets: dict | None = None,
          min_days_of_record: int = 300) -> DataFrame:
    """Build, write, commit and test everything; returns the test report.
    Each table is written once, into a new folder, and all become current in
    one commit: a build that fails leaves the tables of the last one.  Tables
    this build has no input for stay as committed.  The tests read the stored
    tables, so nothing is computed twice for them."""
    base, before = versions.head(spark, out_root)
    folder = versions.new_folder(out_root)
    models = build_models(spark, bronze, seeds, targets, shared_root=folder, min_days_of_record=min_days_of_record)
    stored = [n for n in models if not n.startswith(("stg_", "seed_"))]
    write_models(models, folder, [n for n in stored if n not in SHARED])
    versions.commit(spark, out_root, base, before | {n: os.path.join(folder, n) for n in stored})
    for name in stored:
        models[name] = spark.read.parquet(os.path.join(folder, name))
    return checks.suite(models)
