"""Cell covers, spatial joins, adaptive overlap, nearest and validity against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from fieldlake.functions import geo
from fieldlake.operators import cover, spatial, validity


def star(r, cx, cy, radius, n):
    turns = sorted(r.uniform(0, 2 * math.pi) for _ in range(n))
    at = [(cx + radius * r.uniform(0.3, 1) * math.cos(t), cy + radius * r.uniform(0.3, 1) * math.sin(t)) for t in turns]
    return at + at[:1]


def ring_text(ring):
    return "(" + ", ".join(f"{x!r} {y!r}" for x, y in ring) + ")"


def polygons(seed=1):
    r = random.Random(seed)
    out = []
    for i, radius in enumerate([0.001, 0.02, 0.3, 1, 5, 20, 3, 0.5]):
        cx, cy = r.uniform(-60, 60), r.uniform(-40, 40)
        rings = [star(r, cx, cy, radius, 12)]
        if i % 2:
            rings.append(star(r, cx, cy, radius / 5, 6))
        out.append((i, "POLYGON (" + ", ".join(map(ring_text, rings)) + ")"))
    # corners on cell borders, a hole, two parts, an open ring, a line
    out += [(20, "POLYGON ((0 0, 45 0, 45 22.5, 0 22.5, 0 0), (11.25 5, 22.5 5, 22.5 11.25, 11.25 11.25, 11.25 5))"),
            (21, "MULTIPOLYGON (((90 0, 101.25 0, 101.25 11.25, 90 11.25, 90 0)), ((91 20, 95 20, 95 25, 91 20)))"),
            (22, "POLYGON ((-90 0, -80 0, -80 10, -90 10))"), (23, "LINESTRING (0 0, 10 10)"), (24, "POLYGON EMPTY")]
    return out


def shapes(spark, rows):
    return spark.createDataFrame(rows, "gid long, wkt string").select("gid", geo.parse_wkt("wkt").alias("geom"))


def points_for(seed=2):
    r = random.Random(seed)
    pts = [(r.uniform(-80, 110), r.uniform(-50, 50)) for _ in range(300)]
    for _, wkt in polygons():
        numbers = [float(x) for x in wkt.replace("(", " ").replace(")", " ").replace(",", " ").split()[1:] if x[-1].isdigit()]
        corners = list(zip(numbers[::2], numbers[1::2]))
        for (x, y), (u, v) in zip(corners, corners[1:]):
            pts += [(x, y), ((x + u) / 2, (y + v) / 2), (x + r.uniform(-0.1, 0.1) * (u - x), y + r.uniform(-0.1, 0.1)), (x * 0.7 + u * 0.3, v)]
    pts += [(22.5, 11.25), (11.25, 5.625), (90.0, 5.0), (33.75, 22.5), (45.0, 11.25), (-85.0, 5.0), (-79.0, 5.0)]
    return [(i, x, y) for i, (x, y) in enumerate(pts)] + [(100_000, None, 1.0), (100_001, 5.0, None)]


@pytest.mark.parametrize("geom_id", ["gid", None])
def test_spatial_join_equals_brute_force(spark, geom_id):
    pts = spark.createDataFrame(points_for(), "pid long, x double, y double").cache()
    g = shapes(spark, polygons()).cache()
    want = pts.crossJoin(g).filter(geo.contains_point("geom", "x", "y")).select("pid", "gid").collect()
    got = spatial.spatial_join(pts, g, "x", "y", "geom", geom_id=geom_id).select("pid", "gid").collect()
    assert sorted(got) == sorted(want) and len(want) > 150
    assert spatial.spatial_join(pts, g.limit(0), "x", "y", "geom", geom_id=geom_id).count() == 0


def test_cells_are_disjoint_and_inside_cells_are_inside(spark):
    g = shapes(spark, polygons()).cache()
    cells = cover.cover(g, "gid", "geom").join(g, "gid")
    assert cells.filter("gid IN (23, 24)").count() == 0
    # corners and centre of an inside cell
    s = F.expr(cover.size_of("level"))
    for dx, dy in ((0.0, 0.0), (0.999999, 0.0), (0.0, 0.999999), (0.999999, 0.999999), (0.5, 0.5)):
        at = cells.withColumn("x", (F.col("cx") + dx) * s - 180.0).withColumn("y", (F.col("cy") + dy) * s - 180.0)
        assert at.filter("inside").filter(~geo.contains_point("geom", "x", "y")).count() == 0
    rows = [(r.gid, r.level, r.cx, r.cy) for r in cells.select("gid", "level", "cx", "cy").collect()]
    assert len(set(rows)) == len(rows)
    have = set(rows)
    for gid, level, cx, cy in rows:
        for k in range(1, level + 1):
            assert (gid, level - k, cx >> k, cy >> k) not in have


def test_no_vertices_travel_with_cells(spark):
    plan = cover.cover(shapes(spark, polygons()), "gid", "geom")._jdf.queryExecution().executedPlan().toString()
    for line in plan.split("\n"):
        if "Exchange" in line:
            assert "geom" not in line and "_r" not in line.split("hashpartitioning")[-1]


def test_three_nearest_equal_brute_force_with_ties(spark):
    r = random.Random(4)
    lines = [(i, f"LINESTRING ({r.uniform(-5, 5):.5f} {r.uniform(40, 50):.5f}, {r.uniform(-5, 5):.5f} {r.uniform(40, 50):.5f})") for i in range(30)]
    lines += [(100 + i, w) for i, (_, w) in enumerate(lines[:4])]  # the same lines again: ties
    lines += [(200, "POINT (170 -10)"), (201, "POINT (-175 -10)"), (202, "POINT EMPTY")]
    g = shapes(spark, lines).cache()
    pts = spark.createDataFrame([(j, r.uniform(-12, 12), r.uniform(35, 55)) for j in range(60)] + [(90, 179.0, -9.0), (91, None, 2.0)],
                                "pid int, x double, y double").cache()
    got = sorted((x.pid, x.rank, x.gid, round(x.distance_m, 4)) for x in spatial.nearest_geometries(pts, g, "pid", "gid", "x", "y", "geom", k=3, cell=2.0).collect())
    rows = pts.filter("x IS NOT NULL").crossJoin(g).withColumn("d", geo.distance_to_boundary_m("geom", "x", "y")).filter("d IS NOT NULL").collect()
    want = []
    for pid in {x.pid for x in rows}:
        near = sorted((round(x.d, 4), x.gid) for x in rows if x.pid == pid)[:3]
        want += [(pid, i + 1, gid, d) for i, (d, gid) in enumerate(near)]
    assert got == sorted(want)
    few = spatial.nearest_geometries(pts, g.filter("gid < 2"), "pid", "gid", "x", "y", "geom", k=3, cell=30.0)
    assert {x.pid: x.n for x in few.groupBy("pid").agg(F.count("*").alias("n")).collect()} == {x: 2 for x in [*range(60), 90]}
    inside = spatial.nearest_geometries(spark.createDataFrame([(1, 11.0, 2.0)], "pid int, x double, y double"), shapes(spark, polygons()), "pid", "gid", "x", "y", "geom",
                                        k=1, cell=10.0, inside_is_zero=True).first()
    assert (inside.gid, inside.distance_m) == (20, 0.0)


def lattice_share(rings_in, rings_burnt, level, box):
    """By the middles of all cells of one level."""
    s = 360.0 / 2 ** level

    def odd(rings, x, y):
        return sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for ring in rings for a, b in zip(ring, ring[1:])) % 2 == 1

    total = hit = 0.0
    x0, x1, y0, y1 = (math.floor((v + 180) / s) for v in box)
    for cy in range(y0, y1 + 1):
        area = math.sin(math.radians((cy + 1) * s - 180)) - math.sin(math.radians(cy * s - 180))
        for cx in range(x0, x1 + 1):
            x, y = (cx + 0.5) * s - 180, (cy + 0.5) * s - 180
            if odd(rings_in, x, y):
                total += area
                hit += area * any(odd([b], x, y) for b in rings_burnt)
    return 100 * hit / total


def test_overlap_equals_the_lattice_and_keeps_its_bound(spark):
    r = random.Random(9)
    basins = {i: star(r, 10 + 3 * i, 20 + i, rad, 14) for i, rad in enumerate([0.2, 0.6, 1.4])}
    burns = [star(r, 10 + r.uniform(-1, 7), 20 + r.uniform(-1, 3), r.uniform(0.2, 2), 9) for _ in range(12)]
    # one burn holds basin 9, none meets basin 8; overlapping burns count once
    basins |= {9: [(40, 40), (40.5, 40), (40.5, 40.4), (40, 40)], 8: [(60, 0), (61, 0), (61, 1), (60, 0)]}
    burns += [[(39, 39), (42, 39), (42, 42), (39, 42), (39, 39)]] * 2
    b = shapes(spark, [(i, f"POLYGON ({ring_text(x)})") for i, x in basins.items()] + [(7, "POLYGON EMPTY")])
    f = shapes(spark, [(i, f"POLYGON ({ring_text(x)})") for i, x in enumerate(burns)])
    one = {x.gid: x for x in spatial.overlap_within(b, f, "gid", "geom", "geom", max_error=0.0, start=12, finest=12).collect()}
    for i, ring in basins.items():
        box = (min(x for x, _ in ring), max(x for x, _ in ring), min(y for _, y in ring), max(y for _, y in ring))
        assert abs(one[i].pct_burned - lattice_share([ring], burns, 12, box)) < 1e-6
    assert one[7].pct_burned is None and (one[8].pct_burned, one[8].error_bound) == (0.0, 0.0)
    fine = {x.gid: x for x in spatial.overlap_within(b, f, "gid", "geom", "geom", max_error=2.0, finest=16).collect()}
    best = {x.gid: x for x in spatial.overlap_within(b, f, "gid", "geom", "geom", max_error=0.0, start=16, finest=16).collect()}
    assert len(fine) == len(basins) + 1
    for i in basins:
        assert fine[i].error_bound <= 2.0 or fine[i].level == 16
        assert abs(fine[i].pct_burned - best[i].pct_burned) <= fine[i].error_bound + best[i].error_bound + 1e-9
    assert len({x.level for x in fine.values()}) > 1


def random_rings(r, n):
    """A simple ring, one with random vertices, one where two far edges touch, one with a few long edges amid many short ones."""
    simple = sorted((r.uniform(0, 1), r.uniform(0, 1)) for _ in range(n))
    simple += [(1.5, 2.0), (-0.5, 2.0), simple[0]]
    wild = [(r.uniform(0, 1), r.uniform(0, 1)) for _ in range(n)]
    turn = [(math.cos(2 * math.pi * i / n), math.sin(2 * math.pi * i / n)) for i in range(n)]
    touching = [*turn[:n // 2], turn[n // 7], *turn[n // 2:], turn[0]]
    comb = [(x * 1e-5, y * 1e-5) for x, y in turn[: n - 1]] + [(3.0, 0.5e-5), (3.0, 3.0), (-3.0, 3.0), (1e-5, 1e-9)]
    return {1: simple, 2: [*wild, wild[0]], 3: touching, 4: [*turn, turn[0]], 5: [*comb, comb[0]]}


@pytest.mark.parametrize("n,crowded", [(5, 64), (70, 4), (200, 64)])
def test_validity_by_cells_equals_all_pairs(spark, n, crowded):
    rings = random_rings(random.Random(n), n)
    g = shapes(spark, [(i, f"POLYGON ({ring_text(x)})") for i, x in rings.items()] + [(20, "LINESTRING (0 0, 1 1, 0 1, 1 0)"), (21, "POLYGON ((0 0, 1 0, 1 1, 0 2))"), (22, None)]).cache()
    want = {x.gid: x.why for x in g.select("gid", geo.validity_reason("geom").alias("why")).collect()}
    got = {x.gid: x.reason for x in validity.reasons(g, "gid", "geom", pairwise=4).collect()}
    assert got == want and want[4] is None and (n < 50 or want[2] == want[3] == "self-intersection")
    by_cells = {x.gid for x in validity.crossing_rings(g.filter("gid < 10"), "gid", "geom", crowded=crowded).collect()}
    assert by_cells == {i for i, x in want.items() if x == "self-intersection"}


def test_a_ring_of_many_vertices(spark):
    n = 100_000
    # hangs on id, so that it is not folded into the plan
    turn = f"transform(sequence(0, {n} + CAST(least(id, 0) AS INT)), i -> struct((1 + i % 2 * 1e-7) * cos(2 * pi() * (i % {n}) / {n}) AS x, (1 + i % 2 * 1e-7) * sin(2 * pi() * (i % {n}) / {n}) AS y))"
    g = spark.range(0, 2, 1, 1).selectExpr("id AS gid", f"CASE id WHEN 0 THEN {turn} ELSE concat(slice({turn}, 1, {n // 2}), array(struct(-0.9D AS x, -0.5D AS y), struct(1.1D AS x, 0.5D AS y)), "
                                                 f"slice({turn}, {n // 2}, {n // 2 + 2})) END AS r")
    g = g.selectExpr("gid", "named_struct('gtype', 'POLYGON', 'parts', array(array(r))) AS geom")
    assert {x.gid: x.reason for x in validity.reasons(g, "gid", "geom").collect()} == {0: None, 1: "self-intersection"}


def test_tasks_of_a_cover_grow_in_number_not_in_size(spark, monkeypatch):
    g = shapes(spark, polygons()).coalesce(1).cache()   # one small file: one task would cut all of it
    cells = lambda df: sorted(tuple(x) for x in df.select("gid", "level", "cx", "cy", "inside").collect())
    want = {finest: cells(cover.cover(g, "gid", "geom", finest=finest, depth=depth)) for finest, depth in ((None, 6), (10, 10), (8, 0))}
    monkeypatch.setattr(cover, "TASK_CELLS", 200, raising=False)
    for finest, depth in ((None, 6), (10, 10), (8, 0)):
        got = cover.cover(g, "gid", "geom", finest=finest, depth=depth)
        assert cells(got) == want[finest]
        most = got.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
        assert most[0] <= max(2000, most[1] // 10)
    assert cells(cover.cover(g.filter("gid IN (23, 24)"), "gid", "geom")) == []
