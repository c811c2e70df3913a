import datetime as dt
import math

from pyspark.sql import functions as F

from conftest import rows
from fixtures import daily, envelope, wqp
from fieldlake import schemas
from fieldlake.plans import analyses, marts, staging
from fieldlake.plans.hydrology import daily_features
from fieldlake.sources import versions


def test_stg_wqp_results_cases(spark):
    raw = envelope(spark, [
        (wqp("L1", "S1", "2023-07-01", "Chlorophyll a", "<0.5"), "2024-03-01 00:00:00", "b1"),
        (wqp("L1", "S1", "2023-07-02", "Temperature water", "7.5", unit_key="MeasureUnitCode", unit="deg C"),
         "2024-03-01 00:00:00", "b1"),
        (wqp(None, "S1", "2023-07-03", "Temperature water", "1"), "2024-03-01 00:00:00", "b1"),
        (wqp("L1", "S1", None, "Temperature water", "1"), "2024-03-01 00:00:00", "b1"),
        (wqp("L1", "S2", "2023-07-04", "Phosphorus", "0.02"), "2024-03-01 00:00:00", "b1"),
        (wqp("L1", "S2", "2023-07-04", "Phosphorus", "0.02"), "2024-03-01 00:00:00", "b1"),
        (wqp("L1", "S2", "2023-07-04", "Phosphorus", "0.03"), "2024-03-05 00:00:00", "b2"),
    ])
    out = staging.stg_wqp_results(raw)
    got = rows(out, "station_id", "sample_date", "result_value", "unit_code")
    assert got == [("S1", dt.date(2023, 7, 1), None, "ug/L"), ("S1", dt.date(2023, 7, 2), 7.5, "deg C"),
                   ("S2", dt.date(2023, 7, 4), 0.02, "ug/L")]       # earliest load wins, replicate collapsed
    later = staging.stg_wqp_results(raw, keep="last")
    assert (rows(later.filter("station_id = 'S2'"), "result_value")) == [(0.03,)]


def test_fct_lake_measurements_incremental(spark):
    lakes = spark.createDataFrame([("L1", "Lake One", "Sierra", "CA", 10000, 37.0, -119.0)], schemas.SEED_LAKES)
    raw1 = envelope(spark, [wqp("L1", "S1", "2023-07-01", "Chlorophyll a", "3", det="Not Detected"),
                            wqp("L9", "S1", "2023-07-01", "Chlorophyll a", "3")], "2024-03-01 00:00:00")
    t1 = marts.fct_lake_measurements(staging.stg_wqp_results(raw1), lakes)
    assert rows(t1, "lake_id", "is_non_detect") == [("L1", True)]      # L9 not on the watch list
    raw2 = raw1.unionByName(envelope(spark, [wqp("L1", "S1", "2020-01-01", "Chlorophyll a", "4")], "2024-03-02 00:00:00"))
    t2 = marts.fct_lake_measurements(staging.stg_wqp_results(raw2), lakes, target=t1)
    assert rows(t2, "sample_date") == [(dt.date(2020, 1, 1),), (dt.date(2023, 7, 1),)]  # late sample lands (N19)
    t3 = marts.fct_lake_measurements(staging.stg_wqp_results(raw2), lakes, target=t2)
    assert rows(t3) == rows(t2)                                          # idempotent


def _daily_raw(spark, first, last, loaded_at, start="2020-09-01"):
    base = dt.date.fromisoformat(start)
    recs = []
    for i in range(first, last):
        d = base + dt.timedelta(days=i)
        recs.append((daily("G1", d.isoformat(), 100.0 + 10 * math.sin(i / 5.0)), loaded_at, "b"))
    return envelope(spark, recs)


def test_daily_flow_incremental_equals_full(spark):
    gages = spark.createDataFrame([("G1", "MERCED R NR X", "Merced")], "gage_id string, gage_name string, river_system string")
    load1 = _daily_raw(spark, 0, 300, "2024-01-01 00:00:00")
    t1 = marts.fct_sierra_daily_flow(staging.stg_sierra_daily_flow(load1), gages)
    # second load: the remaining days plus a revision of an old day, loaded later
    load2 = _daily_raw(spark, 300, 400, "2024-02-01 00:00:00")
    rev = envelope(spark, [(daily("G1", "2020-09-10", 555.0), "2024-02-01 00:00:00", "b2")])
    stg_all = staging.stg_sierra_daily_flow(load1.unionByName(load2).unionByName(rev))
    inc = marts.fct_sierra_daily_flow(stg_all, gages, target=t1, segment=F.year("flow_date"))
    full = marts.fct_sierra_daily_flow(stg_all, gages)
    cols = ["flow_date", "discharge_cfs", "prev_discharge_cfs", "change_cfs", "rolling_7d_mean_cfs"]
    r = lambda df: [tuple(round(x, 9) if isinstance(x, float) else x for x in t) for t in rows(df, *cols)]
    assert r(inc) == r(full)
    assert full.filter("flow_date = '2020-09-10'").first()["discharge_cfs"] == 555.0


def test_water_year_boundary_and_thresholds(spark):
    recs = []
    d0 = dt.date(2019, 10, 1)
    for i in range(300):      # WY2020: 300 days
        recs.append((daily("G1", (d0 + dt.timedelta(days=i)).isoformat(), 5.0 + i % 7), "2024-01-01 00:00:00", "b"))
    d1 = dt.date(2020, 10, 1)
    for i in range(299):      # WY2021: 299 days -> dropped
        recs.append((daily("G1", (d1 + dt.timedelta(days=i)).isoformat(), 3.0), "2024-01-01 00:00:00", "b"))
    d2 = dt.date(2021, 10, 1)
    for i in range(310):      # WY2022: all zero -> NULL flashiness
        recs.append((daily("G1", (d2 + dt.timedelta(days=i)).isoformat(), 0.0), "2024-01-01 00:00:00", "b"))
    stg = staging.stg_sierra_daily_flow(envelope(spark, recs))
    from fieldlake.functions.shape import water_year
    bd = spark.createDataFrame([(dt.date(2020, 9, 30),), (dt.date(2020, 10, 1),)], "d date")
    assert rows(bd.select(water_year("d").alias("wy"))) == [(2020,), (2021,)]
    assert stg.filter("flow_date = '2019-10-01'").first()["water_year"] == 2020
    feat = daily_features(stg).withColumn("gage_name", F.lit("x")).withColumn("river_system", F.lit("y"))
    wys = {r["water_year"]: r for r in marts.fct_water_year_summary(feat).collect()}
    assert set(wys) == {2020, 2022}
    assert wys[2022]["rb_flashiness_index"] is None
    assert wys[2020]["wettest_year_rank"] == 1 and wys[2022]["wettest_year_rank"] == 2


def _forest(spark):
    plot = spark.createDataFrame([
        ("P1", 53, 1, 1, 101, 2010, 2010, 1, 47.0, -121.0, 999.0),
        ("P2", 53, 1, 1, 101, 2020, 2020, 1, 47.0, -121.0, 1000.0),
        ("P3", 53, 1, 2, 101, 2015, 2015, 1, 46.0, -120.0, None),
        ("P4", 53, 1, 1, 202, 2015, 2015, 1, None, -120.0, 5000.0)], schemas.FIA_PLOT)
    cond = spark.createDataFrame([
        ("C1", "P1", 2010, 1, 1, 201, 30, 11, 40, 3, 10, 90, 0.5),
        ("C2", "P1", 2010, 2, 2, 201, 30, 11, 10, 3, 10, 90, 0.5),
        ("C3", "P2", 2020, 1, 1, 201, None, 11, 40, 3, 10, 90, None),
        ("C4", "P2", 2020, 2, 1, 201, 200, 11, 20, 3, 10, 90, 0.2),
        ("C5", "P3", 2015, 1, 1, 201, 45, 11, 99, 3, 10, 90, 1.0)], schemas.FIA_COND)
    tree = spark.createDataFrame([
        ("T1", "P1", None, 1, 2010, 1, 202, 10.0, 50.0, 50.0, 40.0, 6.0, 100.0, 200.0, 2),
        ("T2", "P2", "T1.0", 1, 2020, 1, 202, 12.0, 55.0, 55.0, 50.0, 6.0, 120.0, 240.0, 2),
        ("T3", "P2", None, 1, 2020, 2, 263, 4.9, 20.0, 20.0, 30.0, 20.0, 10.0, 20.0, 4),
        ("T4", "P2", None, 1, 2020, 1, 999, None, 30.0, 30.0, 30.0, 10.0, 50.0, 100.0, None),
        ("T5", "P2", None, 1, 2020, 1, 263, 40.0, 30.0, 30.0, 30.0, 10.0, 50.0, 100.0, 1),
        ("T6", "P2", None, 1, 2020, 3, 202, 40.0, 30.0, 30.0, 30.0, 10.0, 50.0, 100.0, 1)], schemas.FIA_TREE)
    species = spark.createDataFrame([
        (202, "Douglas-fir", "Pseudotsuga", "menziesii", "PSME", 10.0, "N", "S"),
        (263, "western hemlock", "Tsuga", "heterophylla", "TSHE", 11.0, "N", "S"),
        (999, "unknown tree", "Tree", "unknown", "2TREE", 48.0, "N", None)], schemas.SEED_FIA_SPECIES)
    return plot, cond, tree, species


def test_forest_models(spark):
    plot, cond, tree, species = _forest(spark)
    sp = staging.stg_fia_plot(plot)
    assert rows(sp, "plot_cn") == [("P1",), ("P2",), ("P3",)]            # NULL lat dropped
    dim = marts.dim_fia_plot(sp, staging.stg_fia_cond(cond))
    d = {r["plot_cn"]: r for r in dim.collect()}
    assert d["P1"]["owner_group"] == "Private"                           # equal proportion -> lower condid
    assert d["P2"]["owner_group"] == "Other federal"                     # NULL proportion last
    assert d["P1"]["elevation_band"] == "Lowland (<1000 ft)"
    assert d["P2"]["elevation_band"] == "Montane (1000-3000 ft)"
    assert d["P3"]["elevation_band"] == "Subalpine (>5000 ft)"           # N5: NULL falls to else
    assert d["P3"]["owner_group"] == "Unknown"
    t = marts.fct_fia_tree(staging.stg_fia_tree(tree), dim, marts.dim_fia_species(species))
    tt = {r["tree_cn"]: r for r in t.collect()}
    assert tt["T3"]["diameter_class"] == "1-5 in" and tt["T4"]["diameter_class"] == "40+ in"
    assert tt["T4"]["crown_class"] is None and tt["T4"]["wood_type"] is None
    g = marts.fct_tree_growth(t)
    gr = g.collect()
    assert len(gr) == 1 and gr[0]["tree_cn"] == "T2" and gr[0]["interval_years"] == 10   # '.0' stripped
    assert gr[0]["annual_diameter_growth_in"] == 0.2
    prof = marts.fct_plot_timber_profile(t, dim)
    p2 = prof.filter("plot_cn = 'P2'").first()
    assert p2["trees_tallied"] == 4 and p2["dead_trees"] == 1 and p2["pct_dead"] == 25.0
    assert p2["live_biomass_tons_per_acre"] == round((240 * 6 + 100 * 10 + 100 * 10) / 2000.0, 2)
    assert p2["sawtimber_stems"] == 2 and p2["stand_stage"] == "Old growth (150+ yr)"
    assert prof.filter("plot_cn = 'P1'").first()["stand_stage"] == "Young (20-40 yr)"
    mort = marts.fct_species_mortality(t, min_trees=1)
    assert "unknown tree" not in [r["species_name"] for r in mort.collect()]
    st = marts.fct_stand_structure(t)
    assert abs(sum(r["pct_of_stems"] for r in st.filter("owner_group = 'Other federal'").collect()) - 100) < 0.2
    owners = analyses.owner_summary(prof)
    assert owners.count() >= 1


def test_fire_models_and_pairing(spark):
    fires_raw = spark.createDataFrame([
        ("1", " big burn ", 2015, "2015", 5000.0, "X", "S", "F", "U1", "POLYGON ((-121.5 46.5, -120.5 46.5, -120.5 47.5, -121.5 47.5, -121.5 46.5))"),
        ("2", "BIG BURN", 2015, "2015", 200.0, "X", "S", "F", "U2", "POLYGON ((-121.1 46.9, -120.9 46.9, -120.9 47.1, -121.1 47.1, -121.1 46.9))"),
        ("3", "OLD", 9999, "9999", 100.0, "X", "S", "F", "U3", "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"),
        ("4", "ZERO", 2015, "2015", 0.0, "X", "S", "F", "U4", "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"),
        ("5", "", 2016, "2016", 10.0, "X", "S", "F", "U5", "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"),
        ("6", "", 2016, "2016", 20.0, "X", "S", "F", "U6", "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))")], schemas.WA_FIRES)
    stg = staging.stg_wa_fires(fires_raw)
    assert rows(stg, "object_id") == [("1",), ("6",)]                    # largest per (year, name); N6 collapse
    assert len(rows(staging.stg_wa_fires(fires_raw, blank_name_uses_id=True), "object_id")) == 3
    fires = marts.dim_wa_fires(stg)
    assert fires.filter("fire_id = '1'").first()["size_class"] == "Moderate (1k-10k ac)"
    prof = spark.createDataFrame([
        ("A", 7, 2010, 2010, 47.0, -121.0, "Private", "Lowland (<1000 ft)", 50.0, 1.0, 10.0, 9, 1, 30, "fir"),
        ("B", 7, 2020, 2020, 47.0, -121.0, "Private", "Lowland (<1000 ft)", 20.0, 9.0, 60.0, 4, 6, 30, "fir"),
        ("C", 7, 2015, 2015, 47.0, -121.0, "Private", "Lowland (<1000 ft)", 30.0, 5.0, 30.0, 5, 5, 30, "fir"),
        ("D", 8, 2020, 2020, 10.0, 10.0, "Private", "Lowland (<1000 ft)", 30.0, 5.0, 30.0, 5, 5, 30, "fir")],
        "plot_cn string, plot_number int, measurement_year int, inventory_year int, latitude double, longitude double, "
        "owner_group string, elevation_band string, live_biomass_tons_per_acre double, dead_biomass_tons_per_acre double, "
        "pct_dead double, live_trees long, dead_trees long, stand_age_years int, dominant_species string")
    hist = marts.fct_plot_fire_history(prof, fires)
    assert rows(hist, "plot_cn", "measurement_timing") == [("A", "Pre-fire"), ("B", "Post-fire"), ("C", "Same year")]
    chg = marts.fct_burned_plot_change(hist).first()
    assert (chg["pre_year"], chg["post_year"], chg["biomass_change_tpa"], chg["pct_biomass_change"]) == (2010, 2020, -30.0, -60.0)
    eff = analyses.fire_effect_by_size(marts.fct_burned_plot_change(hist)).first()
    assert abs(eff["ratio_of_totals"] - (-0.6)) < 1e-12
    assert marts.large_modern_fires(fires).count() == 1


def test_gage_stream_validation_nearest(spark):
    streams_raw = spark.createDataFrame([
        (1, "main", 1, "LINESTRING (-122.09 46.75, -122.07 46.76)"),
        (2, "trib", 1, "LINESTRING (-122.2 46.9, -122.1 46.95)"),
        (3, "start", 1, "POINT (-122.0825 46.7528)")], schemas.DERIVED_STREAMS)
    streams = staging.stg_derived_streams(streams_raw)
    assert streams.count() == 2                                          # start markers dropped
    out = marts.fct_gage_stream_validation(spark, streams).first()
    assert out["segment_id"] == 1 and out["distance_m"] < 200


def test_dim_sierra_gages_and_basin_check(spark):
    raw = spark.createDataFrame([("G1", "MERCED R A HAPPY ISLES", 37.7, -119.5, 100.0,
                                  "POLYGON ((-119.6 37.6, -119.4 37.6, -119.4 37.8, -119.6 37.8, -119.6 37.6))"),
                                 ("G2", "CHERRY C NR X", 37.9, -119.9, None, None)], schemas.SIERRA_GAGES)
    dim = {r["gage_id"]: r for r in marts.dim_sierra_gages(staging.stg_sierra_gages(raw)).collect()}
    assert dim["G1"]["river_system"] == "Merced" and dim["G2"]["river_system"] == "Tuolumne"
    assert abs(dim["G1"]["basin_area_sqmi"] - 151.1) < 0.5 and 1.0 < dim["G1"]["compactness_ratio"] < 1.3


def test_snapshot_stations(spark):
    st = lambda i, name, lat, org, huc="180": {"MonitoringLocationIdentifier": i, "MonitoringLocationName": name,
                                               "LatitudeMeasure": lat, "LongitudeMeasure": -119.0,
                                               "HUCEightDigitCode": huc, "OrganizationIdentifier": org}
    r1 = envelope(spark, [st("A", "a", 1.0, "o"), st("B", "b", 1.0, "o"), st("C", "c", 1.0, "o")])
    s1 = marts.snap_monitoring_stations(r1, None, "2024-01-01")
    r2 = envelope(spark, [st("A", "a", 1.0, "o2"), st("B", "b", 2.0, "o"), st("D", "d", 1.0, "o")])
    s2 = marts.snap_monitoring_stations(r2, s1, "2024-02-01")
    got = rows(s2.select("station_id", F.col("valid_to").isNull().alias("open")))
    assert got == [("A", True), ("B", False), ("B", True), ("C", False), ("D", True)]


def test_snapshot_from_append_only_bronze(spark):
    """Two loads in one bronze table: renamed, moved, unchanged, vanished, new."""
    st = lambda i, name, lat: {"MonitoringLocationIdentifier": i, "MonitoringLocationName": name, "LatitudeMeasure": lat,
                               "LongitudeMeasure": -119.0, "HUCEightDigitCode": "180", "OrganizationIdentifier": "o"}
    first = [(st(i, n, 1.0), "2024-01-01 00:00:00", "b1") for i, n in (("A", "a"), ("B", "b"), ("C", "c"), ("V", "v"))]
    later = [(x, "2024-02-01 00:00:00", "b2") for x in (st("A", "zz", 1.0), st("B", "b", 2.0), st("C", "c", 1.0), st("N", "n", 1.0))]
    s1 = marts.snap_monitoring_stations(envelope(spark, first), None, "2024-01-01")
    s2 = marts.snap_monitoring_stations(envelope(spark, first + later), s1, "2024-02-01")
    got = rows(s2.select("station_id", "station_name", "latitude", F.col("valid_to").isNull().alias("open")))
    assert got == [("A", "a", 1.0, False), ("A", "zz", 1.0, True), ("B", "b", 1.0, False), ("B", "b", 2.0, True), ("C", "c", 1.0, True),
                   ("N", "n", 1.0, True), ("V", "v", 1.0, False)]


def test_declared_suite_and_singular_rules(spark):
    from fieldlake.plans import checks
    plot, cond, tree, species = _forest(spark)
    dim = marts.dim_fia_plot(staging.stg_fia_plot(plot), staging.stg_fia_cond(cond))
    t = marts.fct_fia_tree(staging.stg_fia_tree(tree), dim, marts.dim_fia_species(species))
    rep = {(r["table_name"], r["check_name"]): r for r in
           checks.suite({"dim_fia_plot": dim, "fct_fia_tree": t}).collect()}
    assert rep[("fct_fia_tree", "unique_tree_cn")]["status"] == "pass"
    assert rep[("fct_fia_tree", "relationships_plot_cn")]["failing_rows"] == 0
    assert rep[("fct_fia_tree", "assert_tree_diameter_plausible")]["status"] == "pass"
    assert rep[("dim_fia_plot", "accepted_values_elevation_band")]["status"] == "pass"
    lakes = spark.createDataFrame([("L1", "A", "S", "CA", 1, 37.0, -119.0)], schemas.SEED_LAKES)
    raw = envelope(spark, [wqp("L1", "S1", "2023-07-01", "Chlorophyll a", "501"),
                           wqp("L1", "S1", "2023-07-02", "Chlorophyll a", "-1"),
                           wqp("L1", "S1", "2023-07-03", "Chlorophyll a", "5", unit="ug/l")])
    fct = marts.fct_lake_measurements(staging.stg_wqp_results(raw), lakes)
    rep2 = {r["check_name"]: r for r in checks.suite({"fct_lake_measurements": fct, "dim_lakes": lakes}).collect()}
    assert rep2["assert_no_impossible_chlorophyll"]["failing_rows"] == 2
    assert rep2["accepted_values_unit_code"]["status"] == "warn"
    fr = checks.source_freshness({"wqp": raw}, "2024-03-10 00:00:00").first()
    assert fr["status"] == "error"


def test_filter_contains_if_present(spark):
    from fieldlake.sources.typed import filter_contains_if_present
    df = spark.createDataFrame([("ST", 1), ("LK", 2), ("ST-CA", 3)], "MonitoringLocationTypeName string, k int")
    assert filter_contains_if_present(df, ["site_type", "MonitoringLocationTypeName"], "ST").count() == 2
    assert filter_contains_if_present(df, ["nope"], "ST").count() == 3


def test_build_everything_from_bronze(spark, tmp_dir):
    import os
    from fieldlake.plans import build
    plot, cond, tree, species = _forest(spark)
    lakes = spark.createDataFrame([("L1", "Lake One", "Sierra", "CA", 10000, 37.0, -119.0)], schemas.SEED_LAKES)
    gages = spark.createDataFrame([("G1", "MERCED R", "Merced", "Sierra", "CA", "main")], schemas.SEED_GAGES)
    bronze = {
        "wqp_results_raw": envelope(spark, [wqp("L1", "S1", "2023-07-01", "Chlorophyll a", "3")]),
        "streamflow_continuous_raw": envelope(spark, [{"gage_id": "G1", "parameter_code": "00060", "unit": "cfs",
                                                       "datetime_utc": "2024-01-01T00:15:00", "value": 10.0}]),
        "sierra_gages_raw": spark.createDataFrame([("G1", "MERCED R A HAPPY ISLES", 37.7, -119.5, 151.0,
                                                    "POLYGON ((-119.6 37.6, -119.4 37.6, -119.4 37.8, -119.6 37.8, -119.6 37.6))")],
                                                  schemas.SIERRA_GAGES),
        "sierra_daily_flow_raw": _daily_raw(spark, 0, 400, "2024-01-01 00:00:00"),
        "derived_streams_raw": spark.createDataFrame([(1, "main", 1, "LINESTRING (-122.09 46.75, -122.07 46.76)")],
                                                     schemas.DERIVED_STREAMS),
        "fia_wa_plot_raw": plot, "fia_wa_cond_raw": cond, "fia_wa_tree_raw": tree,
        "wa_fire_perimeters_raw": spark.createDataFrame([
            ("1", "burn", 2015, "2015", 5000.0, "X", "S", "F", "U1",
             "POLYGON ((-121.5 46.5, -120.5 46.5, -120.5 47.5, -121.5 47.5, -121.5 46.5))")], schemas.WA_FIRES),
    }
    out = os.path.join(tmp_dir, "silver")
    report = build.build(spark, bronze, {"lakes": lakes, "gages": gages, "fia_species": species}, out,
                         min_days_of_record=100)
    rep = {(r["table_name"], r["check_name"]): r["status"] for r in report.collect()}
    assert rep[("fct_sierra_daily_flow", "unique_flow_sk")] == "pass"
    assert rep[("fct_lake_measurements", "relationships_lake_id")] == "pass"
    assert rep[("dim_sierra_gages", "assert_basin_area_matches_usgs")] == "pass"
    for name in ("fct_fia_tree", "fct_water_year_summary", "fct_gage_stream_validation", "dim_wa_fires",
                 "fct_sierra_daily_flow"):
        assert versions.read_table(spark, out, name).count() > 0


def test_analyses_small(spark):
    from fieldlake.plans import analyses
    lakes = spark.createDataFrame([("L1", "One"), ("L2", "Two")], "lake_id string, lake_name string")
    meas = spark.createDataFrame([("L1",), ("L1",), ("L1",)], "lake_id string")
    cov = {r["lake_id"]: (r["n_rows"], r["pct_of_rows"]) for r in analyses.lake_coverage(lakes, meas).collect()}
    assert cov == {"L1": (3, 100.0), "L2": (0, 0.0)}                     # D12: lakes without data kept
    prof = spark.createDataFrame([("Private", "Young (20-40 yr)"), ("Private", "Young (20-40 yr)"),
                                  ("Other federal", "Old growth (150+ yr)")], "owner_group string, stand_stage string")
    assert rows(analyses.stage_counts(prof)) == [("Other federal", "Old growth (150+ yr)", 1), ("Private", "Young (20-40 yr)", 2)]
    hist = spark.createDataFrame([(1,), (1,), (2,)], "plot_number int")
    chg = spark.createDataFrame([(1,)], "plot_number int")
    b = analyses.burn_counts(hist, chg).first()
    assert (b["matches"], b["burned_plots"], b["paired_plots"]) == (3, 2, 1)  # D11
    summ = spark.createDataFrame([("G1", 0.5), ("G1", 0.7), ("G2", 0.1), ("G3", 0.3)], "gage_id string, rb_flashiness_index double")
    gages = spark.createDataFrame([("G1", 10.0), ("G2", 1000.0), ("G3", 100.0)], "gage_id string, basin_area_sqmi double")
    d5 = {r["gage_id"]: r for r in analyses.size_vs_flashiness(summ, gages).collect()}
    assert d5["G1"]["corr_all"] < -0.9                                    # D5: bigger basins, less flashy
    growth = spark.createDataFrame([("fir", "Lowland (<1000 ft)", "Private", 60, 0.2, 0.19)],
                                   "species_name string, elevation_band string, owner_group string, remeasured_trees long, "
                                   "mean_annual_growth_in double, median_annual_growth_in double")
    assert analyses.growth_table(growth, "fir").count() == 1              # D13


def test_exports(spark, tmp_dir):
    import os
    from fieldlake.functions import geo
    from fieldlake.sources.geojson import export_layer
    prof = spark.createDataFrame([("A", 7, 2010, 47.0, -121.0), ("B", 7, 2020, 47.1, -121.1), ("C", 7, None, 47.2, -121.2),
                                  ("D", 8, 2015, 46.0, -120.0)],
                                 "plot_cn string, plot_number int, measurement_year int, latitude double, longitude double")
    latest = rows(marts.latest_plot_profile(prof), "plot_number", "plot_cn")
    assert latest == [(7, "B"), (8, "D")]                                 # NULL year last
    change = spark.createDataFrame([(7, "F1", 12.0)], "plot_number int, fire_id string, biomass_change_tpa double")
    pos = marts.burned_pairs_with_position(change, prof).first()
    assert (pos["latitude"], pos["longitude"]) == (47.2, -121.0)          # max lat / max lon per plot number
    fires = spark.createDataFrame([("F1", "BURN", 2015, 5000.0, "Moderate (1k-10k ac)",
                                    "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))")],
                                  "fire_id string, incident_name string, fire_year int, reported_acres double, "
                                  "size_class string, w string").withColumn("fire_geom", geo.parse_wkt("w")).drop("w")
    out = os.path.join(tmp_dir, "layer")
    export_layer(fires, out, "fire_geom")
    back = spark.read.parquet(out).first()
    assert back["geometry_wkt"].startswith("POLYGON ((0.0 0.0") and "fire_geom" not in spark.read.parquet(out).columns
    summ = marts.class_summary(change.withColumn("size_class", F.lit("Moderate (1k-10k ac)")), "size_class",
                               {"mean_change": "biomass_change_tpa"}).first()
    assert (summ["n"], summ["mean_change"]) == (1, 12.0)


def test_incremental_build_equals_full_rebuild(spark):
    from fieldlake.plans import build
    lakes = spark.createDataFrame([("L1", "Lake One", "Sierra", "CA", 10000, 37.0, -119.0)], schemas.SEED_LAKES)
    g = spark.createDataFrame([("G1", "MERCED R", 37.7, -119.5, 151.0,
                                "POLYGON ((-119.6 37.6, -119.4 37.6, -119.4 37.8, -119.6 37.8, -119.6 37.6))")],
                              schemas.SIERRA_GAGES)
    w1 = envelope(spark, [wqp("L1", "S1", "2023-07-01", "Chlorophyll a", "3")], "2024-01-01 00:00:00")
    w2 = envelope(spark, [wqp("L1", "S1", "2023-07-02", "Chlorophyll a", "4"),
                          wqp("L1", "S1", "2023-07-01", "Chlorophyll a", "9")], "2024-01-20 00:00:00")
    d1 = _daily_raw(spark, 0, 200, "2024-01-01 00:00:00")
    d2 = _daily_raw(spark, 200, 260, "2024-01-20 00:00:00")
    seeds = {"lakes": lakes}
    first = build.build_models(spark, {"wqp_results_raw": w1, "sierra_daily_flow_raw": d1, "sierra_gages_raw": g}, seeds)
    targets = {k: first[k] for k in ("fct_lake_measurements", "fct_sierra_daily_flow")}
    all_w, all_d = w1.unionByName(w2), d1.unionByName(d2)
    inc = build.build_models(spark, {"wqp_results_raw": all_w, "sierra_daily_flow_raw": all_d, "sierra_gages_raw": g},
                             seeds, targets=targets)
    full = build.build_models(spark, {"wqp_results_raw": all_w, "sierra_daily_flow_raw": all_d, "sierra_gages_raw": g},
                              seeds)
    for name, cols in (("fct_lake_measurements", ["measurement_sk", "sample_date", "result_value"]),
                       ("fct_sierra_daily_flow", ["flow_sk", "discharge_cfs", "prev_discharge_cfs", "change_cfs",
                                                  "rolling_7d_mean_cfs"])):
        r = lambda df: [tuple(round(x, 9) if isinstance(x, float) else x for x in t) for t in rows(df, *cols)]
        assert r(inc[name]) == r(full[name]), name
