"""Driver-table queries for the geometry operators.

The driver tables carry no geometry, so it is derived arithmetically from
them: every nation gets a diamond polygon (even nation keys with a square
hole) around a centre computed from its key; customers and suppliers get
points computed from their keys (half-step offsets keep points off edges).
The geometry therefore grows with the tables like the real inputs would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import geo
from ..operators import spatial, validity
from .mapped import fr
from .tables import read


def _vertex_text(cx, cy):
    """``v(dx, dy)`` -> the WKT text "x y" of the vertex offset from (cx, cy)."""
    def v(dx, dy):
        return F.concat((cx + dx).cast("string"), F.lit(" "), (cy + dy).cast("string"))
    return v


def nation_polygons(spark, sf) -> DataFrame:
    """WKT diamond of radius 8° around (-170 + 14k, -60 + 30·(k mod 5)); a 2°
    square hole for even k."""
    n = read(spark, sf, "nation").select("n_nationkey", "n_name")
    k = F.col("n_nationkey")
    cx, cy = (F.lit(-170) + 14 * k), (F.lit(-60) + 30 * (k % 5))
    v = _vertex_text(cx, cy)

    outer = F.concat_ws(", ", v(8, 0), v(0, 8), v(-8, 0), v(0, -8), v(8, 0))
    hole = F.concat_ws(", ", v(-2, -2), v(2, -2), v(2, 2), v(-2, 2), v(-2, -2))
    wkt = F.concat(F.lit("POLYGON (("), outer, F.lit(")"),
                   F.when(k % 2 == 0, F.concat(F.lit(", ("), hole, F.lit(")"))).otherwise(F.lit("")),
                   F.lit(")"))
    return n.withColumn("wkt", wkt).withColumn("geom", geo.parse_wkt("wkt"))


def supplier_polygons(spark, sf) -> DataFrame:
    """One diamond of radius 1° per supplier around an integer centre derived
    from its key (a 0.25° square hole for even keys): per-polygon work grows
    with the supplier table."""
    s = read(spark, sf, "supplier").select("s_suppkey")
    k = F.col("s_suppkey")
    cx, cy = F.lit(-170) + (k * 7919) % 340, F.lit(-60) + (k * 104729) % 120
    v = _vertex_text(cx, cy)

    outer = F.concat_ws(", ", v(1, 0), v(0, 1), v(-1, 0), v(0, -1), v(1, 0))
    hole = F.concat_ws(", ", v(-0.25, -0.25), v(0.25, -0.25), v(0.25, 0.25), v(-0.25, 0.25), v(-0.25, -0.25))
    wkt = F.concat(F.lit("POLYGON (("), outer, F.lit(")"),
                   F.when(k % 2 == 0, F.concat(F.lit(", ("), hole, F.lit(")"))).otherwise(F.lit("")), F.lit(")"))
    return s.withColumn("cx", cx).withColumn("cy", cy).withColumn("wkt", wkt).withColumn("geom", geo.parse_wkt("wkt"))


def customer_points(spark, sf) -> DataFrame:
    c = read(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return c.select("c_custkey", "c_nationkey",
                    (F.lit(-180.0) + ((F.col("c_custkey") * 7919) % 360000 + 0.5) / 1000.0).alias("lon"),
                    (F.lit(-70.0) + ((F.col("c_custkey") * 104729) % 140000 + 0.5) / 1000.0).alias("lat"))


def supplier_points(spark, sf) -> DataFrame:
    s = read(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    k = F.col("s_nationkey")
    # near the supplier's own nation centre, spread by key
    return s.select("s_suppkey", "s_nationkey",
                    (F.lit(-170.0) + 14 * k + ((F.col("s_suppkey") * 7919) % 24000 + 0.5) / 1000.0 - 12.0).alias("lon"),
                    (F.lit(-60.0) + 30 * (k % 5) + ((F.col("s_suppkey") * 104729) % 24000 + 0.5) / 1000.0 - 12.0)
                    .alias("lat"))


def spatial_join_grid(spark, sf):
    """Customers inside nation polygons via the cell equi-join."""
    pts = customer_points(spark, sf)
    pol = nation_polygons(spark, sf).select("n_nationkey", "geom")
    return spatial.spatial_join(pts, pol, "lon", "lat", "geom", geom_id="n_nationkey").select("c_custkey", "n_nationkey")


def point_in_polygon(spark, sf):
    """G5 flag for every customer (left join of the grid-join matches)."""
    pts = customer_points(spark, sf)
    hits = spatial_join_grid(spark, sf).groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n_polygons"))
    return (pts.join(hits, "c_custkey", "left")
               .select("c_custkey", F.coalesce("n_polygons", F.lit(0).cast("long")).alias("n_polygons"),
                       F.col("n_polygons").isNotNull().alias("inside")))


def polygon_area(spark, sf):
    """Spherical area, perimeter and compactness per polygon."""
    p = (supplier_polygons(spark, sf)
         .select("s_suppkey", "geom", geo.area_m2("geom").alias("_a"), geo.length_m("geom").alias("_p")))
    # area and perimeter are evaluated once and reused by the compactness ratio
    return p.select("s_suppkey", fr(F.col("_a") / 1e6, 6).alias("area_km2"), fr(F.col("_p") / 1e3, 6).alias("perimeter_km"),
                    fr(geo.compactness("_p", "_a"), 6).alias("compactness"),
                    geo.n_vertices("geom").alias("n_vertices"))


def geo_distance(spark, sf):
    """Metres from each supplier to its own nation's polygon boundary."""
    s = supplier_points(spark, sf)
    p = nation_polygons(spark, sf).select("n_nationkey", "geom")
    j = s.join(F.broadcast(p), s.s_nationkey == p.n_nationkey)  # nation polygons: fixed 25 rows
    return j.select("s_suppkey", "n_nationkey", F.round(geo.distance_to_boundary_m("geom", "lon", "lat"), 3)
                    .alias("distance_m"))


def nearest_geom(spark, sf):
    """Nearest nation polygon boundary for every supplier (grid search)."""
    s = supplier_points(spark, sf)
    p = nation_polygons(spark, sf).select("n_nationkey", "geom")
    # cell ~ half a polygon: most points settle in the first search square
    out = spatial.nearest_geometry(s, p, "s_suppkey", "n_nationkey", "lon", "lat", "geom", cell=8.0)
    return out.select("s_suppkey", "n_nationkey", F.round("distance_m", 3).alias("distance_m"))


def bbox_assign(spark, sf):
    """Customers tagged with every nation box (±8°) that holds them."""
    pts = customer_points(spark, sf)
    n = read(spark, sf, "nation").select("n_nationkey")
    k = F.col("n_nationkey")
    boxes = n.select("n_nationkey", (F.lit(-170) + 14 * k - 8).cast("double").alias("xmin"),
                     (F.lit(-170) + 14 * k + 8).cast("double").alias("xmax"),
                     (F.lit(-60) + 30 * (k % 5) - 8).cast("double").alias("ymin"),
                     (F.lit(-60) + 30 * (k % 5) + 8).cast("double").alias("ymax"))
    return spatial.assign_to_boxes(pts, boxes, "lon", "lat", "xmin", "xmax", "ymin", "ymax", cell=2.0) \
        .select("c_custkey", "n_nationkey")


def wkt_roundtrip(spark, sf):
    """G2 + G14: parse then print WKT."""
    p = supplier_polygons(spark, sf)
    return p.select("s_suppkey", geo.as_wkt("geom").alias("wkt_out"))


def geometry_validity(spark, sf):
    """Validity per polygon; odd keys divisible by 3 get two vertices
    swapped (bow tie)."""
    p = supplier_polygons(spark, sf)
    k = F.col("s_suppkey")
    v = _vertex_text(F.col("cx"), F.col("cy"))

    bow = F.concat(F.lit("POLYGON (("), F.concat_ws(", ", v(1, 0), v(-1, 0), v(0, 1), v(0, -1), v(1, 0)), F.lit("))"))
    p = p.withColumn("wkt2", F.when((k % 2 == 1) & (k % 3 == 0), bow).otherwise(F.col("wkt")))
    p = p.withColumn("g2", geo.parse_wkt("wkt2"))
    return validity.reasons(p, "s_suppkey", "g2").select("s_suppkey", F.col("reason").isNull().alias("is_valid"), "reason")


def reproject_points(spark, sf):
    """Projected metres (derived from customer keys) -> lon/lat."""
    c = read(spark, sf, "customer").select("c_custkey")
    x = (F.col("c_custkey") * 7919) % 4000000 - 2000000.0
    y = (F.col("c_custkey") * 104729) % 2500000 + 500000.0
    ll = geo.albers_to_lonlat(x, y)
    return c.select("c_custkey", F.round(ll.x, 7).alias("lon"), F.round(ll.y, 7).alias("lat"))


def point_report(spark, sf):
    """Each customer against its own nation polygon: inside flag and km
    to the perimeter (0 inside); pairs are explicit (customer, nation)."""
    pts = customer_points(spark, sf)
    pol = nation_polygons(spark, sf).select("n_nationkey", "geom")
    pairs = pts.select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    out = spatial.point_report(pairs, pts, pol, "c_custkey", "n_nationkey", "lon", "lat", "geom")
    return out.select("c_custkey", "n_nationkey", "inside", F.round("distance_km", 3).alias("distance_km"))


def repair_geometry(spark, sf):
    """G13 (+ G8, G14): an open outer ring with a repeated first vertex is
    repaired (consecutive duplicates dropped, ring closed)."""
    p = supplier_polygons(spark, sf).select("s_suppkey", "cx", "cy")
    v = _vertex_text(F.col("cx"), F.col("cy"))

    broken = F.concat(F.lit("POLYGON (("), F.concat_ws(", ", v(1, 0), v(1, 0), v(0, 1), v(-1, 0), v(0, -1)),
                      F.lit("))"))
    g = p.withColumn("wkt", broken).withColumn("g", geo.parse_wkt("wkt")).withColumn("fixed", geo.repair("g"))
    return g.select("s_suppkey", geo.validity_reason("g").alias("reason_before"),
                    geo.as_wkt("fixed").alias("wkt_after"), geo.is_valid("fixed").alias("valid_after"))


def region_burns(spark, sf) -> DataFrame:
    """One rectangular "burn" per region, 30° x 50.2°, placed from the region key."""
    r = read(spark, sf, "region").select("r_regionkey")
    x0 = F.lit(-172.9) + 70 * F.col("r_regionkey")
    x0s, x1s = x0.cast("string"), (x0 + 30).cast("string")
    wkt = F.concat(F.lit("POLYGON (("), x0s, F.lit(" -20.1, "), x1s, F.lit(" -20.1, "), x1s, F.lit(" 30.1, "),
                   x0s, F.lit(" 30.1, "), x0s, F.lit(" -20.1))"))
    return r.withColumn("bwkt", wkt).withColumn("bgeom", geo.parse_wkt("bwkt"))


def overlap_fraction(spark, sf):
    """Share of each supplier polygon (holes excluded) covered by
    any burn, from a 0.35° lattice weighted by cos(latitude)."""
    basins = supplier_polygons(spark, sf).select("s_suppkey", "geom")
    burns = region_burns(spark, sf).select("bgeom")
    out = spatial.overlap_percent(basins, burns, "s_suppkey", "geom", "bgeom", resolution=0.35, cell=2.0, min_steps=1)
    return out.select("s_suppkey", fr("pct_burned", 6).alias("pct_burned"))


def overlap_adaptive(spark, sf):
    """G11 / D14 by cells of one grid (level 12, 0.09°): share of each
    supplier polygon covered by any burn."""
    basins = supplier_polygons(spark, sf).select("s_suppkey", "geom")
    out = spatial.overlap_within(basins, region_burns(spark, sf), "s_suppkey", "geom", "bgeom", max_error=0.0, start=12, finest=12)
    return out.select("s_suppkey", fr("pct_burned", 6).alias("pct_burned"))


def nearest_three(spark, sf):
    """G7 with k = 3: the three nearest nation polygons of every supplier."""
    p = nation_polygons(spark, sf).select("n_nationkey", "geom")
    out = spatial.nearest_geometries(supplier_points(spark, sf), p, "s_suppkey", "n_nationkey", "lon", "lat", "geom", k=3, cell=16.0)
    return out.select("s_suppkey", F.col("rank").cast("long").alias("rank"), "n_nationkey", F.round("distance_m", 3).alias("distance_m"))


def customer_rings(spark, sf) -> DataFrame:
    """Two rings for every 64 customers: their points in the order of keys,
    and from west to east, closed by way of latitude 80."""
    c = customer_points(spark, sf).withColumn("block", F.floor(F.col("c_custkey") / 64).cast("long"))
    at = F.struct(F.col("lon").alias("x"), F.col("lat").alias("y"))
    g = c.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("c_custkey", at.alias("p")))).alias("by_key"),
                               F.sort_array(F.collect_list(F.struct("lon", "c_custkey", at.alias("p")))).alias("by_lon"))
    g = g.select("block", F.expr("transform(by_key, q -> q.p)").alias("k"), F.expr("transform(by_lon, q -> q.p)").alias("l"))
    top = "named_struct('x', element_at(l, {}).x, 'y', 80D)"
    rings = g.selectExpr("block", "explode(array(named_struct('gid', 2 * block, 'r', concat(k, slice(k, 1, 1))), "
                                  f"named_struct('gid', 2 * block + 1, 'r', concat(l, array({top.format(-1)}, {top.format(1)}), slice(l, 1, 1))))) AS q")
    return rings.selectExpr("block", "q.gid", "named_struct('gtype', 'POLYGON', 'parts', array(array(q.r))) AS geom")


def ring_crossings(spark, sf):
    """G8 / Q8 for long rings: whether edges that are no neighbours touch,
    by grid cells."""
    rings = customer_rings(spark, sf)
    hit = validity.crossing_rings(rings.select("gid", "geom"), "gid", "geom").select("gid", F.lit(True).alias("hit"))
    crosses = F.coalesce("hit", F.lit(False))
    return (rings.select("block", "gid").join(hit, "gid", "left").groupBy("block")
                 .agg(F.bool_or(crosses & (F.col("gid") % 2 == 0)).alias("by_key_crosses"), F.bool_or(crosses & (F.col("gid") % 2 == 1)).alias("by_lon_crosses")))


QUERIES = {
    "overlap_adaptive": overlap_adaptive,
    "nearest_three": nearest_three,
    "ring_crossings": ring_crossings,
    "overlap_fraction": overlap_fraction,
    "point_report": point_report,
    "repair_geometry": repair_geometry,
    "spatial_join_grid": spatial_join_grid,
    "point_in_polygon": point_in_polygon,
    "polygon_area": polygon_area,
    "geo_distance": geo_distance,
    "nearest_geom": nearest_geom,
    "bbox_assign": bbox_assign,
    "wkt_roundtrip": wkt_roundtrip,
    "geometry_validity": geometry_validity,
    "reproject_points": reproject_points,
}
