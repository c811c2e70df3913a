"""Command line: the reference's four everyday commands on Spark.

  python -m fieldlake ingest --landing DIR --table NAME --bronze DIR   NDJSON(.gz) -> append to bronze (S1, S2)
                                                                       CSV / GeoJSON -> replace a static table (S3, S5, S8)
  python -m fieldlake build  --bronze DIR --seeds DIR --out DIR        every model + tests (the build step)
           [--incremental] [--as-of TS]                                upsert into the stored facts; take a snapshot (M29)
  python -m fieldlake fresh  --bronze DIR [--now TS]                   source freshness (Q10)
  python -m fieldlake export --silver DIR --out DIR                    map layers (M30, S12)

Bronze tables are Parquet folders named after the bronze table
(``wqp_results_raw``, ``fia_wa_tree_raw``, ...); seeds are ``lakes.csv``,
``gages.csv``, ``fia_species.csv``.  Master, memory and partitions come from
spark-submit / the environment.
"""

from __future__ import annotations

import argparse
import os
import sys

BRONZE = ["wqp_results_raw", "wqp_stations_raw", "streamflow_continuous_raw", "sierra_daily_flow_raw",
          "sierra_gages_raw", "derived_streams_raw", "fia_wa_plot_raw", "fia_wa_cond_raw", "fia_wa_tree_raw",
          "wa_fire_perimeters_raw"]
# raw sources with a declared freshness; the stations and the daily flows have none
FRESH_SOURCES = ["wqp_results_raw", "streamflow_continuous_raw"]
RAW_ENVELOPES = ["wqp_results_raw", "wqp_stations_raw", "streamflow_continuous_raw", "sierra_daily_flow_raw"]


def _exists(spark, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _bronze(spark, root: str) -> dict:
    return {n: spark.read.parquet(os.path.join(root, n)) for n in BRONZE if _exists(spark, os.path.join(root, n))}


def _seeds(spark, root: str) -> dict:
    from . import schemas
    from .sources.typed import read_seed
    spec = {"lakes": schemas.SEED_LAKES, "gages": schemas.SEED_GAGES, "fia_species": schemas.SEED_FIA_SPECIES}
    return {n: read_seed(spark, os.path.join(root, f"{n}.csv"), s) for n, s in spec.items()
            if _exists(spark, os.path.join(root, f"{n}.csv"))}


def main(argv=None, spark=None) -> int:
    ap = argparse.ArgumentParser(prog="fieldlake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("--landing", required=True)
    a.add_argument("--table", required=True, choices=BRONZE)
    a.add_argument("--bronze", required=True)
    b = sub.add_parser("build")
    b.add_argument("--bronze", required=True)
    b.add_argument("--seeds", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--min-days", type=int, default=300)
    b.add_argument("--incremental", action="store_true")
    b.add_argument("--as-of", default=None)
    f = sub.add_parser("fresh")
    f.add_argument("--bronze", required=True)
    f.add_argument("--now", default=None)
    e = sub.add_parser("export")
    e.add_argument("--silver", required=True)
    e.add_argument("--out", required=True)
    args = ap.parse_args(argv)

    from .session import get_session
    spark = spark or get_session()
    if args.cmd == "ingest":
        from .sources import bronze, raw, tables
        if args.table in bronze.LOADERS:
            path = os.path.join(args.bronze, args.table)
            raw.replace_bronze(bronze.LOADERS[args.table](spark, args.landing), path)
            stored = spark.read.parquet(path)
            audit = tables.load_audit(stored, "fire_year" if "fire_year" in stored.columns else None).first()
            print(f"replaced {args.table}: {audit.asDict()}")
            return 0
        df = raw.read_raw_json(spark, args.landing, raw.batch_id())
        raw.append_bronze(df, os.path.join(args.bronze, args.table))
        print(f"appended {spark.read.parquet(os.path.join(args.bronze, args.table)).count()} rows in {args.table}")
        return 0
    if args.cmd == "build":
        from .plans import build
        report = build.build(spark, _bronze(spark, args.bronze), _seeds(spark, args.seeds), args.out,
                             targets=build.stored_targets(spark, args.out, args.incremental, args.as_of),
                             min_days_of_record=args.min_days)
        bad = report.filter("status != 'pass'")
        bad.show(max(1, bad.count()), truncate=False)
        return 1 if bad.filter("status = 'fail'").limit(1).count() else 0
    if args.cmd == "fresh":
        import datetime as dt
        from .plans.checks import source_freshness
        now = args.now or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        srcs = {n: d for n, d in _bronze(spark, args.bronze).items() if n in FRESH_SOURCES}
        if not srcs:
            print("no raw sources found")
            return 0
        rep = source_freshness(srcs, now)
        rep.show(truncate=False)
        return 1 if rep.filter("status = 'error'").limit(1).count() else 0
    if args.cmd == "export":
        from .plans import marts
        from .sources import versions
        from .sources.geojson import export_layer
        out = 0

        def table(name):
            return versions.read_table(spark, args.silver, name) if versions.table_path(spark, args.silver, name) else None

        def put(df, name):
            # positions stay as latitude / longitude columns
            df.write.mode("overwrite").parquet(os.path.join(args.out, name))
            return spark.read.parquet(os.path.join(args.out, name))

        profile, fires, change = (table(n) for n in ("fct_plot_timber_profile", "dim_wa_fires", "fct_burned_plot_change"))
        if profile is not None:
            latest = put(marts.latest_plot_profile(profile).drop("plot_geom"), "latest_plots")
            put(marts.owner_summary(latest), "owner_summary").show(truncate=False)
            out += 1
        if fires is not None:
            export_layer(fires.filter("fire_year >= 2000 AND reported_acres >= 1000"),
                         os.path.join(args.out, "large_modern_fires"), "fire_geom")
            out += 1
        if change is not None and profile is not None:
            pairs = put(marts.burned_pairs_with_position(change, profile), "burned_pairs")
            put(marts.burned_size_summary(pairs), "burned_size_summary").show(truncate=False)
            out += 1
        print(f"wrote {out} layer(s)")
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
