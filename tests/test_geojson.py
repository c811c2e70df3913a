"""One document read by many tasks, whatever the order of its members."""

import json
import os

import pytest

from fieldlake.functions import geo
from fieldlake.sources import geojson

LINE = {"type": "LineString", "coordinates": [[0, 0], [1.5, -2e-1, 7]]}


def put(folder, name, text):
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(text)
    return os.path.join(folder, name)


def features(n, order):
    whole = {"type": "Feature", "properties": None, "geometry": LINE, "id": 0}
    return [{k: whole[k] if k != "properties" else {"n": i, "t": 'a "quoted" } ] { [', "in": {"b": [1, {"c": 2}]}} for k in order} for i in range(n)]


@pytest.mark.parametrize("order", [("type", "properties", "geometry"), ("type", "geometry", "properties", "id"),
                                   ("geometry", "id", "properties", "type"), ("id", "type", "properties", "geometry")])
@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("tail", [False, True])
def test_orders_of_members(spark, tmp_dir, order, indent, tail):
    doc = {"type": "FeatureCollection", "name": "features", "features": features(7, order)}
    if tail:
        doc |= {"bbox": [0, 0, 1, 1], "crs": {"type": "name", "properties": {"name": "x"}}}
    got = geojson.read_geojson(spark, put(tmp_dir, "a.geojson", json.dumps(doc, indent=indent))).collect()
    assert sorted(r.properties["n"] for r in got) == [str(i) for i in range(7)]
    assert {r.geom_wkt for r in got} == {"LINESTRING (0 0, 1.5 -0.2)"} or {r.geom_wkt for r in got} == {"LINESTRING (0 0, 1.5 -2e-1)"}
    assert all(r.properties["t"] == 'a "quoted" } ] { [' for r in got)


def test_one_file_is_read_by_many_tasks(spark, tmp_dir):
    p = put(tmp_dir, "big.geojson", json.dumps({"type": "FeatureCollection", "features": features(30000, ("type", "properties", "geometry"))}))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        df = geojson.read_geojson(spark, p)
        assert df.rdd.getNumPartitions() >= os.path.getsize(p) // (256 << 10)
        assert sorted(int(r.n) for r in df.selectExpr("properties['n'] AS n").collect()) == list(range(30000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_collections_empties_and_missing_geometries(spark, tmp_dir):
    point = {"type": "Point", "coordinates": [3, 4]}
    area = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}
    given = [{"type": "GeometryCollection", "geometries": [point, area]}, {"type": "GeometryCollection", "geometries": []},
             {"type": "GeometryCollection", "geometries": [{"type": "GeometryCollection", "geometries": [area]}]},
             {"type": "Polygon", "coordinates": []}, None, {"type": "Circle", "coordinates": [1, 2]}]
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"n": i}, "geometry": g} for i, g in enumerate(given)]}
    df = geojson.read_geojson(spark, put(tmp_dir, "c.geojson", json.dumps(doc)))
    ring = "POLYGON ((0 0, 1 0, 1 1, 0 0))"
    assert [r.geom_wkt for r in df.orderBy("properties.n").collect()] == [
        f"GEOMETRYCOLLECTION (POINT (3 4), {ring})", "GEOMETRYCOLLECTION EMPTY", f"GEOMETRYCOLLECTION (GEOMETRYCOLLECTION ({ring}))",
        "POLYGON EMPTY", None, None]
    parsed = df.withColumn("g", geo.parse_wkt("geom_wkt")).orderBy("properties.n").select("g.gtype", "g.parts").collect()
    assert parsed[0].gtype == "MULTIPOLYGON" and len(parsed[0].parts[0][0]) == 4


@pytest.mark.parametrize("text, n", [('{"type":"FeatureCollection","features":[]}', 0), ('{"features": [ ], "type": "FeatureCollection"}', 0),
                                     ('{"type":"Feature","properties":{"a":1},"geometry":null}', 1), ("", 0)])
def test_small_documents(spark, tmp_dir, text, n):
    assert geojson.read_geojson(spark, put(tmp_dir, "s.geojson", text)).count() == n


@pytest.mark.parametrize("feature", [{"geometry": LINE, "type": "Feature", "properties": {"a": 1}},
                                     {"type": "Feature", "properties": {"type": "Feature"}, "geometry": LINE},
                                     {"type": "Feature", "properties": {"kind": "Feature", "b": 2}, "geometry": LINE}])
def test_what_cannot_be_cut_raises(spark, tmp_dir, feature):
    p = put(tmp_dir, "bad.geojson", json.dumps({"type": "FeatureCollection", "features": [feature] * 3}))
    with pytest.raises(Exception, match="cannot cut a GeoJSON file"):
        geojson.read_geojson(spark, p).collect()


def test_written_layers_come_back(spark, tmp_dir):
    wkts = ["POINT (1 2)", "LINESTRING (0 0, 1 1)", "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))", "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))",
            "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))", None]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(wkts)], "n int, w string").withColumn("g", geo.parse_wkt("w"))
    geojson.write_geojson(df.repartition(2), os.path.join(tmp_dir, "out"), "g")
    back = geojson.read_geojson(spark, os.path.join(tmp_dir, "out")).withColumn("b", geo.parse_wkt("geom_wkt"))
    got = {int(r.n): (r.w, r.b) for r in back.selectExpr("properties['n'] AS n", "properties['w'] AS w", "b").collect()}
    want = {r.n: (r.w, r.g) for r in df.collect()}
    assert {k: v for k, v in got.items() if v[0]} == {k: v for k, v in want.items() if v[0]} and len(got) == 6
