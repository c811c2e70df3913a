import gzip
import json
import os
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from fieldlake import schemas
from fieldlake.sources import geojson, raw, tables, typed, versions
from fieldlake.streaming import landing


def _write_gz(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write("\n".join(lines) + "\n")


def test_read_raw_json_strict_and_quarantine(spark, tmp_dir):
    p = os.path.join(tmp_dir, "land", "a.json.gz")
    _write_gz(p, [json.dumps({"gage_id": "1", "value": 2.5}), "", json.dumps({"gage_id": "2"})])
    df = raw.read_raw_json(spark, p, "20240101_deadbeef", loaded_at="2024-01-01 00:00:00")
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["variant", "timestamp_ntz", "string"]
    assert rows(df.select(F.variant_get("payload", "$.gage_id", "string").alias("g")), "g") == [("1",), ("2",)]
    bad = os.path.join(tmp_dir, "land2", "b.json.gz")
    _write_gz(bad, [json.dumps({"a": 1}), "{not json"])
    with pytest.raises(Exception):
        raw.read_raw_json(spark, bad, "b").collect()
    good, q = raw.quarantine(raw.read_raw_json(spark, bad, "b", strict=False))
    assert good.count() == 1 and q.count() == 1
    assert len(raw.batch_id()) == 17


def test_write_ndjson_roundtrip(spark, tmp_dir):
    out = os.path.join(tmp_dir, "nd")
    df = spark.createDataFrame([(1, "2024-01-01")], "k int, d string").withColumn("d", F.to_date("d"))
    raw.write_ndjson(df, out)
    back = spark.read.json(out)
    assert rows(back) == [("2024-01-01", 1)]


def test_typed_csv_drift_tolerant(spark, tmp_dir):
    p = os.path.join(tmp_dir, "plot.csv")
    with open(p, "w") as f:
        f.write("CN,STATECD,EXTRA,PLOT,INVYR,LAT,LON,ELEV\n")
        f.write('"123456789012345",53,x,101,2010,47.1,-121.2,\n')
    df = typed.read_typed_csv(spark, p, schemas.FIA_PLOT)
    assert df.columns == ["cn", "statecd", "plot", "invyr", "lat", "lon", "elev"]   # missing skipped, order kept
    r = df.first()
    assert r["cn"] == "123456789012345" and r["elev"] is None and r["statecd"] == 53
    assert typed.resolve_column(df, ["nope", "LAT"]) == "lat"


def test_seed_quoted_comma(spark, tmp_dir):
    p = os.path.join(tmp_dir, "species.csv")
    with open(p, "w") as f:
        f.write("SPCD,COMMON_NAME,GENUS,SPECIES,SPECIES_SYMBOL,E_SPGRPCD,WOODLAND,SFTWD_HRDWD\n")
        f.write('431,"chinkapin, golden",Chrysolepis,chrysophylla,CHCHC4,44,N,H\n')
    r = typed.read_seed(spark, p, schemas.SEED_FIA_SPECIES).first()
    assert r["COMMON_NAME"] == "chinkapin, golden" and r["SPCD"] == 431


def test_geojson_to_wkt(spark, tmp_dir):
    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"INCIDENT": "A", "FIRE_YEAR_INT": 2015, "GIS_ACRES": 12.5},
         "geometry": {"type": "Polygon", "coordinates": [[[-121, 47], [-120, 47], [-120, 48], [-121, 47]]]}},
        {"type": "Feature", "properties": {"IncidentName": "B", "GIS_ACRES": None},
         "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]],
                                                              [[[2, 2], [3, 2], [3, 3], [2, 2]]]]}}]}
    p = os.path.join(tmp_dir, "fires.geojson")
    with open(p, "w") as f:
        json.dump(fc, f)
    df = geojson.read_geojson(spark, p)
    out = df.select(geojson.property_of("properties", ["INCIDENT", "IncidentName"]).alias("name"),
                    geojson.property_of("properties", ["FIRE_YEAR_INT"], "int").alias("yr"), "geom_wkt").collect()
    assert out[0]["name"] == "A" and out[0]["yr"] == 2015
    assert out[0]["geom_wkt"] == "POLYGON ((-121 47, -120 47, -120 48, -121 47))"
    assert out[1]["geom_wkt"].startswith("MULTIPOLYGON (((0 0, 1 0")
    assert out[1]["name"] == "B"


def test_load_audit_and_clustered_write(spark, tmp_dir):
    df = spark.createDataFrame([(1999,), (2005,), (2010,)], "y int")
    a = tables.load_audit(df, "y").first()
    assert (a["n_rows"], a["min_year"], a["max_year"], a["n_since_2000"]) == (3, 1999, 2010, 2)
    out = os.path.join(tmp_dir, "clustered")
    tables.clustered_write(spark.range(1000).withColumn("d", F.col("id") % 10), out, ["d", "id"], n_files=4)
    assert spark.read.parquet(out).count() == 1000
    v = tables.materialize(spark, df, "audit_view")
    assert v.count() == 3


def test_streaming_first_wins_and_upsert(spark, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    schema = "k string, v double, event_ts timestamp, d string"
    with open(os.path.join(land, "1.json"), "w") as f:
        f.write(json.dumps({"k": "a", "v": 1.0, "event_ts": "2024-01-01T00:00:00Z", "d": "2024-01-01"}) + "\n")
        f.write(json.dumps({"k": "a", "v": 2.0, "event_ts": "2024-01-01T00:00:00Z", "d": "2024-01-01"}) + "\n")
        f.write(json.dumps({"k": "b", "v": 3.0, "event_ts": "2024-01-01T01:00:00Z", "d": "2024-01-01"}) + "\n")
    s = landing.read_landing(spark, land, schema)
    q = (landing.stream_first_wins(s, ["k"], "event_ts").writeStream.format("memory").queryName("fw")
         .option("checkpointLocation", os.path.join(tmp_dir, "ck1")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert sorted(r["k"] for r in spark.table("fw").collect()) == ["a", "b"]
    target = os.path.join(tmp_dir, "target")
    q2 = landing.stream_upsert(landing.read_landing(spark, land, schema), target, ["k"], "v", ["d"],
                               os.path.join(tmp_dir, "ck2"))
    q2.awaitTermination(120)
    assert rows(spark.read.parquet(target), "k", "v") == [("a", 2.0), ("b", 3.0)]


def test_bucketed_tables_join_without_shuffle(spark):
    trees = spark.range(0, 5000).select((F.col("id") % 500).alias("plot_cn"), F.col("id").alias("tree_cn"),
                                        (F.col("id") % 7).cast("double").alias("dia"))
    plots = spark.range(0, 500).select(F.col("id").alias("plot_cn"), (F.col("id") % 3).alias("owner"))
    t = tables.bucketed_table(trees, "fl_bucket_trees", "plot_cn", 8)
    p = tables.bucketed_table(plots, "fl_bucket_plots", "plot_cn", 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = t.groupBy("plot_cn").agg(F.sum("dia").alias("s")).join(p, "plot_cn")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, plan
        assert j.count() == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_cli_ingest_build_fresh_export(spark, tmp_dir):
    from fieldlake.__main__ import main
    land = os.path.join(tmp_dir, "landing")
    _write_gz(os.path.join(land, "a.json.gz"), [json.dumps({"gage_id": "G1", "flow_date": f"2020-{m:02d}-{d:02d}",
                                                            "discharge_cfs": 10.0 + d, "approval": "A"})
                                                for m in range(1, 13) for d in range(1, 29)])
    bronze, seeds, out, maps = (os.path.join(tmp_dir, x) for x in ("bronze", "seeds", "silver", "maps"))
    assert main(["ingest", "--landing", land, "--table", "sierra_daily_flow_raw", "--bronze", bronze], spark) == 0
    spark.createDataFrame([("G1", "MERCED R", 37.7, -119.5, 151.0,
                            "POLYGON ((-119.6 37.6, -119.4 37.6, -119.4 37.8, -119.6 37.8, -119.6 37.6))")],
                          schemas.SIERRA_GAGES).write.parquet(os.path.join(bronze, "sierra_gages_raw"))
    spark.createDataFrame([("1", "burn", 2015, "2015", 5000.0, "X", "S", "F", "U1",
                            "POLYGON ((-121.5 46.5, -120.5 46.5, -120.5 47.5, -121.5 47.5, -121.5 46.5))")],
                          schemas.WA_FIRES).write.parquet(os.path.join(bronze, "wa_fire_perimeters_raw"))
    os.makedirs(seeds)
    with open(os.path.join(seeds, "gages.csv"), "w") as f:
        f.write("gage_id,gage_name,river,mountain_range,state_code,role\nG1,MERCED R,Merced,Sierra,CA,main\n")
    assert main(["build", "--bronze", bronze, "--seeds", seeds, "--out", out, "--min-days", "100"], spark) == 0
    assert versions.read_table(spark, out, "fct_water_year_summary").count() >= 1
    assert main(["fresh", "--bronze", bronze, "--now", "2000-01-01 00:00:00"], spark) == 0   # loaded "in the future"
    assert main(["export", "--silver", out, "--out", maps], spark) == 0
    assert spark.read.parquet(os.path.join(maps, "large_modern_fires")).count() == 1


def test_command_line_loads_static_tables_from_files(spark, tmp_dir):
    """CSV and GeoJSON files -> bronze -> build up to the fire history."""
    import json
    import os

    from fieldlake.__main__ import main
    land, bronze, seeds, out = (os.path.join(tmp_dir, d) for d in ("land", "bronze", "seeds", "out"))
    os.makedirs(land), os.makedirs(seeds)

    def put(name, text):
        with open(os.path.join(land, name), "w") as f:
            f.write(text)
        return os.path.join(land, name)

    plots = [f"P{i}{y},53,1,7,{i},{y},{y},1,47.5,-120.5,3000,extra" for i in (1, 2) for y in (2008, 2018)]
    files = {
        "fia_wa_plot_raw": put("plot.csv", "CN,STATECD,UNITCD,COUNTYCD,PLOT,INVYR,MEASYEAR,PLOT_STATUS_CD,LAT,LON,ELEV,OTHER\n" + "\n".join(plots)),
        "fia_wa_cond_raw": put("cond.csv", "CN,PLT_CN,INVYR,CONDID,COND_STATUS_CD,FORTYPCD,STDAGE,OWNCD,OWNGRPCD,SITECLCD,SLOPE,ASPECT,CONDPROP_UNADJ\n"
                               + "\n".join(f"C{i}{y},P{i}{y},{y},1,1,201,80,11,10,3,10,180,1.0" for i in (1, 2) for y in (2008, 2018))),
        "fia_wa_tree_raw": put("tree.csv", "CN,PLT_CN,PREV_TRE_CN,CONDID,INVYR,STATUSCD,SPCD,DIA,HT,ACTUALHT,TOTAGE,TPA_UNADJ,CARBON_AG,DRYBIO_AG,CCLCD\n"
                               + "\n".join(f"T{i}{y}{s},P{i}{y},,1,{y},{s},202,{10 + s},50,50,,6.0,100,{200 * s},3" for i in (1, 2) for y in (2008, 2018) for s in (1, 2))),
        "wa_fire_perimeters_raw": put("fires.geojson", json.dumps({"type": "FeatureCollection", "features": [
            {"type": "Feature", "properties": {"OBJECTID": 1, "INCIDENT": "Big", "FIRE_YEAR_INT": 2012, "FIRE_YEAR": "2012", "GIS_ACRES": 5000.5},
             "geometry": {"type": "Polygon", "coordinates": [[[-121, 47], [-120, 47], [-120, 48], [-121, 48], [-121, 47]]]}},
            {"type": "Feature", "properties": {"OBJECTID": 2, "INCIDENT": None, "FIRE_YEAR_INT": 0, "GIS_ACRES": None},
             "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}},
            {"type": "Feature", "properties": {"OBJECTID": 3, "FIRE_YEAR_INT": "x", "GIS_ACRES": "many"}, "geometry": None}]})),
        "derived_streams_raw": put("streams.geojson", json.dumps({"type": "FeatureCollection", "features": [
            {"type": "Feature", "properties": {"cat": 4, "stream_type": "main", "network": 1},
             "geometry": {"type": "LineString", "coordinates": [[-119.56, 37.73], [-119.55, 37.74]]}}]})),
        "sierra_gages_raw": put("gages.geojson", json.dumps({"type": "FeatureCollection", "features": [
            {"type": "Feature", "properties": {"gage_id": "G1", "gage_name": "MERCED R", "latitude": 37.7, "longitude": -119.5, "drainage_area": "n/a"},
             "geometry": {"type": "Polygon", "coordinates": [[[-119.6, 37.6], [-119.4, 37.6], [-119.4, 37.8], [-119.6, 37.6]]]}}]})),
    }
    for name, path in files.items():
        assert main(["ingest", "--landing", path, "--table", name, "--bronze", bronze], spark) == 0
    fires = {r.object_id: r for r in spark.read.parquet(os.path.join(bronze, "wa_fire_perimeters_raw")).collect()}
    assert (fires["1"].gis_acres, fires["1"].fire_year) == (5000.5, 2012)
    assert (fires["2"].gis_acres, fires["2"].fire_year, fires["2"].incident_name) == (0.0, None, "")
    assert (fires["3"].gis_acres, fires["3"].fire_year, fires["3"].geom_wkt) == (None, None, None)
    assert spark.read.parquet(os.path.join(bronze, "sierra_gages_raw")).first().drainage_area is None
    with open(os.path.join(seeds, "fia_species.csv"), "w") as f:
        f.write("SPCD,COMMON_NAME,GENUS,SPECIES,SPECIES_SYMBOL,E_SPGRPCD,WOODLAND,SFTWD_HRDWD\n202,Douglas-fir,Pseudotsuga,menziesii,PSME,10,N,S\n")
    main(["build", "--bronze", bronze, "--seeds", seeds, "--out", out], spark)
    history = versions.read_table(spark, out, "fct_plot_fire_history")
    assert {(r.plot_number, r.measurement_year, r.measurement_timing) for r in history.collect()} == {
        (p, y, t) for p in {r.plot_number for r in history.collect()} for y, t in ((2008, "Pre-fire"), (2018, "Post-fire"))}
    assert history.count() == 4
    assert versions.read_table(spark, out, "fct_burned_plot_change").count() == 2
    maps = os.path.join(tmp_dir, "burned-maps")
    assert main(["export", "--silver", out, "--out", maps], spark) == 0
    pairs = spark.read.parquet(os.path.join(maps, "burned_pairs"))
    assert pairs.count() == 2 and pairs.where("latitude IS NULL OR longitude IS NULL").count() == 0
    assert [r.pairs for r in spark.read.parquet(os.path.join(maps, "burned_size_summary")).collect()] == [2]
    owners = spark.read.parquet(os.path.join(maps, "owner_summary"))
    assert owners.columns == ["owner_group", "plots", "mean_biomass", "mean_pct_dead"]
    assert sum(r.plots for r in owners.collect()) == spark.read.parquet(os.path.join(maps, "latest_plots")).count()


def test_incremental_builds_equal_one_full_build(spark, tmp_dir):
    import json
    import os

    from fieldlake.__main__ import main
    bronze, seeds, once, twice = (os.path.join(tmp_dir, d) for d in ("bronze", "seeds", "once", "twice"))
    os.makedirs(seeds)
    for n, text in (("lakes", "lake_id,lake_name,mountain_range,state_code,elevation_ft,latitude,longitude\n"),
                    ("gages", "gage_id,gage_name,river,mountain_range,state_code,role\nG1,One,R,Sierra,CA,main\n")):
        with open(os.path.join(seeds, f"{n}.csv"), "w") as f:
            f.write(text)
    reading = lambda day, v: {"gage_id": "G1", "parameter_code": "00060", "unit": "cfs", "datetime_utc": f"2024-01-{day:02d}T00:00:00", "value": v,
                              "qualifier": "A"}
    station = lambda i, name: {"MonitoringLocationIdentifier": i, "MonitoringLocationName": name, "LatitudeMeasure": 1.0, "LongitudeMeasure": 2.0,
                               "HUCEightDigitCode": "1", "OrganizationIdentifier": "o"}

    def land(step, rows, table):
        path = os.path.join(tmp_dir, f"{table}-{step}.json")
        with open(path, "w") as f:
            f.write("\n".join(map(json.dumps, rows)))
        main(["ingest", "--landing", path, "--table", table, "--bronze", bronze], spark)

    build_it = lambda out, *more: main(["build", "--bronze", bronze, "--seeds", seeds, "--out", out, *more], spark)
    land(1, [reading(1, 1.0), reading(2, 2.0)], "streamflow_continuous_raw")
    land(1, [station("A", "a"), station("B", "b")], "wqp_stations_raw")
    build_it(twice, "--incremental", "--as-of", "2024-01-01")
    land(2, [reading(2, 2.5), reading(3, 3.0)], "streamflow_continuous_raw")
    land(2, [station("A", "z")], "wqp_stations_raw")
    build_it(twice, "--incremental", "--as-of", "2024-02-01")
    build_it(once)
    read_ = lambda root, n: sorted(str(sorted(r.asDict().items())) for r in versions.read_table(spark, root, n).collect())
    assert read_(once, "fct_streamflow") == read_(twice, "fct_streamflow") != []
    snap = versions.read_table(spark, twice, "snap_monitoring_stations")
    got = sorted((r.station_id, r.station_name, r.valid_to is None) for r in snap.collect())
    assert got == [("A", "a", False), ("A", "z", True), ("B", "b", False)]
