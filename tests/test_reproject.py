"""Whole geometries there and back, and densified edges."""

import math

import pytest
from pyspark.sql import functions as F

from fieldlake.functions import geo

WKT = ["POINT (-120.5 46.2)", "LINESTRING (-122 46, -121 47, -118.25 45.5)", "POLYGON ((-121 46, -119 46, -119 48, -121 48, -121 46), (-120 47, -119.5 47, -119.5 47.5, -120 47))",
       "MULTILINESTRING ((-100 30, -99 31), (-70 45, -69 44))", "MULTIPOLYGON (((-96 23, -95 23, -95 24, -96 23)), ((-80 40, -79 40, -79 41, -80 40)))",
       "POLYGON EMPTY", None]


def flat(g):
    return None if g is None or g.parts is None else [(v.x, v.y) for p in g.parts for r in p or [] for v in r]


def test_there_and_back(spark):
    df = spark.createDataFrame([(i, w) for i, w in enumerate(WKT)], "i int, w string").withColumn("g", geo.parse_wkt("w"))
    df = df.withColumn("m", geo.reproject("g", "albers")).withColumn("b", geo.reproject("m"))
    for r in df.orderBy("i").collect():
        assert (r.g is None or r.g.gtype is None) or r.m.gtype == r.g.gtype == r.b.gtype
        a, b = flat(r.g), flat(r.b)
        assert (a is None) == (b is None) and len(a or []) == len(b or [])
        assert all(abs(x - u) < 1e-6 and abs(y - v) < 1e-6 for (x, y), (u, v) in zip(a or [], b or []))
    origin = df.where("i = 4").first().m.parts[0][0][0]
    assert abs(origin.x) < 1e-6 and abs(origin.y) < 1e-6            # the projection's own origin


def test_densified_edges(spark):
    df = spark.createDataFrame([(i, w) for i, w in enumerate(WKT + ["LINESTRING (0 0, 1 x, 9 9)"])], "i int, w string").withColumn("g", geo.parse_wkt("w"))
    for r in df.withColumn("d", geo.densify("g", 0.3)).collect():
        for p, q in zip((r.g.parts or []) if r.g else [], (r.d.parts or []) if r.d else []):
            for before, after in zip(p or [], q or []):
                here = [(v.x, v.y) for v in after]
                assert [v for v in here if v in {(o.x, o.y) for o in before}] == [(o.x, o.y) for o in before]
                if all(None not in v for v in here):
                    assert all(math.dist(a, b) <= 0.3 + 1e-9 for a, b in zip(here, here[1:]))
                else:
                    assert len(here) == len(before)
    with pytest.raises(ValueError):
        geo.densify("g", 0)


def test_a_densified_edge_follows_the_straight_line(spark):
    """Half-way along a long projected edge, the densified line is where the plain one is not."""
    df = spark.sql("SELECT 'LINESTRING (-2000000 2500000, 2000000 2500000)' AS w").withColumn("g", geo.parse_wkt("w"))
    line = df.select(geo.reproject("g", max_edge=10000.0).alias("d")).first().d.parts[0][0]
    exact = df.select(geo.albers_to_lonlat(F.lit(0.0), F.lit(2500000.0)).alias("p")).first().p
    assert min(math.dist((v.x, v.y), (exact.x, exact.y)) for v in line) < 1e-9
    assert abs((line[0].y + line[-1].y) / 2 - exact.y) > 1
