import math
import random

from pyspark.sql import functions as F

from conftest import rows
from fieldlake.functions import geo
from fieldlake.operators import spatial


def _g(spark, wkts):
    return spark.createDataFrame([(i, w) for i, w in enumerate(wkts)], "id int, wkt string") \
                .withColumn("g", geo.parse_wkt("wkt"))


def test_area_closed_forms(spark):
    df = _g(spark, ["POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))",
                    "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0), (0.25 0.25, 0.75 0.25, 0.75 0.75, 0.25 0.75, 0.25 0.25))",
                    "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((0 0, 1 0, 1 1, 0 1, 0 0), (0.25 0.25, 0.75 0.25, 0.75 0.75, 0.25 0.75, 0.25 0.25)))"])
    a = {r["id"]: r["a"] for r in df.select("id", (geo.area_m2("g") / 1e6).alias("a")).collect()}
    assert abs(a[0] - 12363.72) < 0.01
    assert abs(a[1] - 9272.76) < 0.01
    assert abs(a[2] - (a[0] + a[1])) < 1e-6


def test_circle_compactness_near_one(spark):
    ring = ", ".join(f"{0.01 * math.cos(t):.9f} {0.01 * math.sin(t):.9f}"
                     for t in [2 * math.pi * k / 720 for k in range(720)] + [0.0])
    df = _g(spark, [f"POLYGON (({ring}))"])
    c = df.select(geo.compactness(geo.length_m("g"), geo.area_m2("g")).alias("c")).first()["c"]
    assert abs(c - 1.0) < 1e-3


def test_contains_holes_boundary_and_validity(spark):
    df = _g(spark, ["POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 3 1, 3 3, 1 3, 1 1))",
                    "POLYGON ((0 0, 1 1, 1 0, 0 1, 0 0))", "POLYGON ((0 0, 1 0, 1 1, 0 0))",
                    "POLYGON ((0 0, 1 0, 1 1, 0 1))", "LINESTRING (0 0, 1 1)", "POLYGON ((0 0, 200 0, 1 1, 0 0))",
                    "POLYGON ((0 0, 1 0, 0 0))"])
    out = {r["id"]: r for r in df.select(
        "id", geo.contains_point("g", "0.5D", "0.5D").alias("in_ring"), geo.contains_point("g", "2D", "2D").alias("in_hole"),
        geo.contains_point("g", "4D", "2D").alias("on_edge"), geo.validity_reason("g").alias("why")).collect()}
    assert out[0]["in_ring"] and not out[0]["in_hole"] and out[0]["on_edge"]
    assert out[0]["why"] is None
    assert out[1]["why"] == "self-intersection"
    assert out[2]["why"] is None
    assert out[3]["why"] == "ring not closed"
    assert out[6]["why"] == "ring too short"
    assert out[4]["why"] is None
    assert out[5]["why"] == "coordinates"


def test_repair_and_wkt_roundtrip(spark):
    df = _g(spark, ["POLYGON ((0 0, 1 0, 1 0, 1 1, 0 1))"])
    fixed = df.withColumn("f", geo.repair("g"))
    assert fixed.select(geo.as_wkt("f")).first()[0] == "POLYGON ((0.0 0.0, 1.0 0.0, 1.0 1.0, 0.0 1.0, 0.0 0.0))"
    assert fixed.select(geo.is_valid("f")).first()[0]


def test_grid_join_equals_brute_force(spark):
    rnd = random.Random(5)
    polys = []
    for i in range(30):
        cx, cy, r = rnd.uniform(-20, 20), rnd.uniform(-20, 20), rnd.uniform(0.5, 6)
        pts = [(cx + r * math.cos(t) * rnd.uniform(0.6, 1), cy + r * math.sin(t) * rnd.uniform(0.6, 1))
               for t in [2 * math.pi * k / 9 for k in range(9)]]
        ring = ", ".join(f"{x:.6f} {y:.6f}" for x, y in pts + pts[:1])
        polys.append((i, f"POLYGON (({ring}))"))
    pol = spark.createDataFrame(polys, "pid int, wkt string").withColumn("geom", geo.parse_wkt("wkt"))
    pts = spark.createDataFrame([(j, rnd.uniform(-25, 25), rnd.uniform(-25, 25)) for j in range(2000)],
                                "qid int, x double, y double")
    grid = rows(spatial.spatial_join(pts, pol, "x", "y", "geom", cell=1.5).select("qid", "pid"))
    brute = rows(pts.crossJoin(pol).filter(geo.contains_point("geom", "x", "y")).select("qid", "pid"))
    assert grid == brute and len(grid) > 50


def test_nearest_equals_brute_force(spark):
    rnd = random.Random(11)
    lines = [(i, f"LINESTRING ({rnd.uniform(-5, 5):.5f} {rnd.uniform(40, 50):.5f}, {rnd.uniform(-5, 5):.5f} {rnd.uniform(40, 50):.5f})")
             for i in range(40)]
    g = spark.createDataFrame(lines, "sid int, wkt string").withColumn("geom", geo.parse_wkt("wkt"))
    pts = spark.createDataFrame([(j, rnd.uniform(-30, 30), rnd.uniform(20, 70)) for j in range(150)],
                                "pid int, x double, y double")
    near = {r["pid"]: (r["sid"], round(r["distance_m"], 6)) for r in
            spatial.nearest_geometry(pts, g, "pid", "sid", "x", "y", "geom", cell=0.5).collect()}
    d = pts.crossJoin(g).withColumn("d", geo.distance_to_boundary_m("geom", "x", "y"))
    best = d.groupBy("pid").agg(F.min(F.struct("d", "sid")).alias("b")).collect()
    brute = {r["pid"]: (r["b"]["sid"], round(r["b"]["d"], 6)) for r in best}
    assert near == brute


def test_distance_far_away_and_across_the_antimeridian(spark):
    import math
    r = 6371008.8 if not hasattr(geo, "R") else geo.R

    def hav(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        return 2 * r * math.asin(math.sqrt(math.sin((d - b) / 2) ** 2 + math.cos(b) * math.cos(d) * math.sin((c - a) / 2) ** 2))

    geoms = [(1, "LINESTRING (10 60, 10 61)"), (2, "LINESTRING (179.5 0, 179.9 0)"), (3, "LINESTRING (-170 10, -169 10)"),
             (4, "LINESTRING (0 0, 20 0)"), (5, "LINESTRING (179 5, -179 5)")]
    g = spark.createDataFrame(geoms, "sid int, wkt string").withColumn("geom", geo.parse_wkt("wkt"))
    pts = spark.createDataFrame([(1, -20.0, 60.0), (2, -179.9, 0.1), (3, 10.0, 30.0), (4, 180.0, 5.5), (5, None, 1.0)], "pid int, x double, y double")
    d = {(x.pid, x.sid): x.d for x in pts.crossJoin(g).withColumn("d", geo.distance_to_boundary_m("geom", "x", "y")).collect()}
    assert abs(d[1, 1] - hav(-20, 60, 10, 61)) < 1 or abs(d[1, 1] - hav(-20, 60, 10, 60)) < 1 or d[1, 1] < hav(-20, 60, 10, 60)
    assert abs(d[2, 2] - hav(-179.9, 0.1, 179.9, 0)) < 1e-3
    assert abs(d[3, 4] - math.radians(30) * r) < 1e-3          # straight down to the equator
    assert d[4, 5] < math.radians(0.51) * r                    # an edge over the antimeridian
    assert d[5, 1] is None
    near = {x.pid: (x.sid, x.distance_m) for x in spatial.nearest_geometry(pts, g, "pid", "sid", "x", "y", "geom", cell=0.01).collect()}
    assert near[5] == (None, None) and len(near) == 5
    for p in (1, 2, 3, 4):
        sid = min((1, 2, 3, 4, 5), key=lambda s: (d[p, s], s))
        assert near[p][0] == sid and abs(near[p][1] - d[p, sid]) < 1e-6
    nothing = spatial.nearest_geometry(pts, g.limit(0), "pid", "sid", "x", "y", "geom").collect()
    assert sorted(x.pid for x in nothing) == [1, 2, 3, 4, 5] and all(x.sid is None for x in nothing)


def test_collections_empty_and_broken_geometry(spark):
    square = "((0 0, 1 0, 1 1, 0 1, 0 0))"
    given = [("poly", f"POLYGON {square}"), ("coll", f"GEOMETRYCOLLECTION (POINT (5 5), POLYGON {square}, LINESTRING (0 0, 9 9))"),
             ("multi", f"GEOMETRYCOLLECTION (MULTIPOLYGON ({square}, ((2 2, 3 2, 3 3, 2 3, 2 2))), MULTILINESTRING ((0 0, 9 9), (1 1, 2 2)))"),
             ("lines", "GEOMETRYCOLLECTION (LINESTRING (0 0, 9 9))"), ("empty", "POLYGON EMPTY"), ("mempty", "MULTIPOLYGON EMPTY"),
             ("gempty", "GEOMETRYCOLLECTION EMPTY"), ("bad", "POLYGON ((0 0, 1 x9, 1 1, 0 0))"), ("half", "LINESTRING (0 0, 7)"), ("null", None),
             ("odd", "CIRCLE (1 2)")]
    g = spark.createDataFrame(given, "id string, wkt string").withColumn("geom", geo.parse_wkt("wkt"))
    g = g.withColumn("x", F.lit(0.5)).withColumn("y", F.lit(0.5))
    got = {r.id: r for r in g.select("id", geo.area_m2("geom").alias("area"), geo.length_m("geom").alias("length"),
                                     geo.contains_point("geom", "x", "y").alias("inside"), geo.distance_to_boundary_m("geom", "x", "y").alias("d"),
                                     geo.compactness(geo.length_m("geom"), geo.area_m2("geom")).alias("c"),
                                     geo.parse_problem("wkt", "geom").alias("problem")).collect()}
    assert got["coll"].inside and got["coll"].area == got["poly"].area and got["multi"].area > 1.9 * got["poly"].area
    assert got["lines"].area == 0 and got["empty"].area == 0 and got["mempty"].area == 0 and not got["empty"].inside and got["empty"].d is None
    assert {k: r.problem for k, r in got.items() if r.problem} == {
        "lines": "no vertices", "empty": "no vertices", "mempty": "no vertices", "gempty": "no vertices", "bad": "bad coordinate",
        "half": "bad coordinate", "null": "missing", "odd": "unknown type"}


def test_overlap_of_a_small_basin(spark):
    basin = spark.createDataFrame([("in", "POLYGON ((0 0, 0.001 0, 0.001 0.001, 0 0.001, 0 0))"), ("flat", "POLYGON ((5 5, 5 5, 5 5, 5 5))")],
                                  "gage_id string, w string").withColumn("basin_geom", geo.parse_wkt("w"))
    fires = spark.createDataFrame([("POLYGON ((-1 -1, 1 -1, 1 1, -1 1, -1 -1))",)], "w string").withColumn("fire_geom", geo.parse_wkt("w"))
    got = {x.gage_id: x.pct_burned for x in
           spatial.overlap_percent(basin, fires.select("fire_geom"), "gage_id", "basin_geom", "fire_geom").collect()}
    assert got["in"] == 100.0 and got["flat"] in (None, 0.0)


def test_overlap_percent_square(spark):
    basin = spark.createDataFrame([("b1", "POLYGON ((0 0, 1 0, 1 1, 0 1, 0 0))"), ("b2", "POLYGON ((5 5, 6 5, 6 6, 5 6, 5 5))")],
                                  "gage_id string, w string").withColumn("basin_geom", geo.parse_wkt("w"))
    fires = spark.createDataFrame([("POLYGON ((0.5 -1, 2 -1, 2 2, 0.5 2, 0.5 -1))",)], "w string") \
                 .withColumn("fire_geom", geo.parse_wkt("w"))
    got = {r["gage_id"]: r["pct_burned"] for r in
           spatial.overlap_percent(basin, fires, "gage_id", "basin_geom", "fire_geom", resolution=0.02).collect()}
    assert abs(got["b1"] - 50.0) < 1.0 and got["b2"] == 0.0


def test_albers_roundtrip(spark):
    k = geo._albers_constants()
    a, e, e2, n, C, rho0 = k["a"], k["e"], k["e2"], k["n"], k["C"], k["rho0"]

    def fwd(lon, lat):  # Snyder forward, ellipsoid
        phi = math.radians(lat)
        q = k["q"](phi)
        rho = a * math.sqrt(C - n * q) / n
        th = n * math.radians(lon - k["lon0"])
        return rho * math.sin(th), rho0 - rho * math.cos(th)

    pts = [(-122.0825, 46.7528), (-96.0, 23.0), (-75.0, 40.0), (-119.5, 37.7)]
    df = spark.createDataFrame([(i, *fwd(lo, la)) for i, (lo, la) in enumerate(pts)], "i int, x double, y double")
    got = {r["i"]: r["p"] for r in df.select("i", geo.albers_to_lonlat("x", "y").alias("p")).collect()}
    for i, (lo, la) in enumerate(pts):
        assert abs(got[i]["x"] - lo) < 1e-9 and abs(got[i]["y"] - la) < 1e-6
