"""Geometry as native Spark columns.

A geometry is ``struct<gtype: string, parts: array<array<array<struct<x,y>>>>>``:
parts -> rings (ring 0 outer, the rest holes; a line part holds one ring) ->
vertices (x = lon, y = lat, WGS84 degrees).  Every function returns a Column
built from higher-order SQL functions, so it runs in the JVM next to the data
with no Python round trip.  Measures are spherical (mean earth radius); expect
up to ~0.6 % difference from an ellipsoidal model.  Rings crossing the
antimeridian are not supported.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, functions as F

from ..constants import EARTH_RADIUS_M

R = EARTH_RADIUS_M
DEG = math.pi / 180.0


def _sql(c) -> str:
    """SQL text for a column reference (name, dotted path or SQL expression)."""
    if not isinstance(c, str):
        raise TypeError("geometry functions take a column name or SQL expression string")
    if re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", c):
        return f"`{c}`"
    return c


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- G1 --------------------------------------------------------------------------
def point(lon, lat) -> Column:
    """point(lon, lat) -- lon first."""
    return F.struct(_c(lon).cast("double").alias("x"), _c(lat).cast("double").alias("y"))


def point_geom(lon, lat) -> Column:
    return F.struct(F.lit("POINT").alias("gtype"),
                    F.array(F.array(F.array(point(lon, lat)))).alias("parts"))


# ---- G2: WKT -> geometry ---------------------------------------------------------------
_VERTS = ("transform(split(trim({r}), '\\\\s*,\\\\s*'), v -> named_struct("
          "'x', try_cast(get(split(trim(v), '\\\\s+'), 0) AS double), "
          "'y', try_cast(get(split(trim(v), '\\\\s+'), 1) AS double)))")
_RINGS = "regexp_extract_all({p}, '([^()]*[0-9][^()]*)', 1)"


def parse_wkt(wkt: str) -> Column:
    """POINT, LINESTRING, POLYGON, MULTILINESTRING, MULTIPOLYGON (2-D), and
    GEOMETRYCOLLECTION, of which the polygons are kept, as a MULTIPOLYGON.
    EMPTY geometries have no vertices; a coordinate that is no number is NULL.
    See :func:`parse_problem` for what could not be read."""
    w = _sql(wkt)
    gtype = f"upper(regexp_extract({w}, '^\\\\s*([A-Za-z]+)', 1))"
    body = f"regexp_replace({w}, '^\\\\s*[A-Za-z]+\\\\s*', '')"
    rings_of_p = f"transform({_RINGS.format(p='p')}, r -> {_VERTS.format(r='r')})"
    multi = (f"transform(split({body}, '\\\\)\\\\s*\\\\)\\\\s*,\\\\s*\\\\(\\\\s*\\\\('), "
             f"p -> {rings_of_p})")
    rings_body = f"transform({_RINGS.format(p=body)}, r -> {_VERTS.format(r='r')})"
    lines = f"transform({_RINGS.format(p=body)}, r -> array({_VERTS.format(r='r')}))"
    areas = f"regexp_replace({w}, '(?i)(MULTILINESTRING|MULTIPOINT)\\\\s*\\\\((\\\\s*\\\\([^()]*\\\\)\\\\s*,?)+\\\\s*\\\\)', '')"
    members = f"regexp_extract_all({areas}, '\\\\((?:\\\\s*\\\\([^()]*\\\\)\\\\s*,?)+\\\\s*\\\\)', 0)"
    collected = f"transform({members}, p -> {rings_of_p})"
    label = f"(CASE WHEN {gtype} = 'GEOMETRYCOLLECTION' AND size({members}) > 0 THEN 'MULTIPOLYGON' ELSE {gtype} END)"
    sql = (f"named_struct('gtype', {label}, 'parts', CASE {gtype} WHEN 'GEOMETRYCOLLECTION' THEN {collected} "
           f"WHEN 'MULTIPOLYGON' THEN {multi} WHEN 'MULTILINESTRING' THEN {lines} "
           f"ELSE array({rings_body}) END)")
    return F.expr(sql)


def parse_problem(wkt: str, geom: str) -> Column:
    """Why a geometry needs a look: 'missing', 'unknown type', 'no vertices',
    'bad coordinate'; NULL if nothing is wrong.  Rows with a reason can be set
    aside before a build; none of them makes an expression here fail."""
    w, g = _sql(wkt), _sql(geom)
    known = "('POINT', 'LINESTRING', 'POLYGON', 'MULTILINESTRING', 'MULTIPOLYGON', 'GEOMETRYCOLLECTION')"
    v = f"flatten(flatten({g}.parts))"
    return F.expr(f"CASE WHEN {w} IS NULL OR trim({w}) = '' THEN 'missing' WHEN {g}.gtype NOT IN {known} THEN 'unknown type' "
                  f"WHEN size({v}) = 0 THEN 'no vertices' WHEN exists({v}, q -> q.x IS NULL OR q.y IS NULL) THEN 'bad coordinate' END")


# ---- building blocks (SQL text) ------------------------------------------------------------
def _edge_len(a: str, b: str) -> str:
    return (f"(2 * {R} * asin(sqrt(pow(sin((radians({b}.y) - radians({a}.y)) / 2), 2) + "
            f"cos(radians({a}.y)) * cos(radians({b}.y)) * pow(sin((radians({b}.x) - radians({a}.x)) / 2), 2))))")


def _ring_len(r: str, i: str = "i1") -> str:
    return (f"(CASE WHEN size({r}) < 2 THEN 0D ELSE aggregate(sequence(0, size({r}) - 2), 0D, "
            f"(acc1, {i}) -> acc1 + {_edge_len(f'{r}[{i}]', f'{r}[{i} + 1]')}) END)")


def _ring_area(r: str, i: str = "i2") -> str:
    term = (f"(radians({r}[{i} + 1].x) - radians({r}[{i}].x)) * "
            f"(2 + sin(radians({r}[{i}].y)) + sin(radians({r}[{i} + 1].y)))")
    return (f"(CASE WHEN size({r}) < 4 THEN 0D ELSE abs(aggregate(sequence(0, size({r}) - 2), 0D, "
            f"(acc2, {i}) -> acc2 + {term})) * {R * R / 2.0} END)")


def _part_area(p: str) -> str:
    holes = f"aggregate(slice({p}, 2, size({p}) - 1), 0D, (acc3, hr) -> acc3 + {_ring_area('hr', 'i3')})"
    return f"(CASE WHEN size({p}) = 0 THEN 0D ELSE {_ring_area(f'{p}[0]')} - {holes} END)"


# ---- G3 / G4 ------------------------------------------------------------------------------
def area_m2(geom: str) -> Column:
    """Spherical area in m²: outer minus holes, summed over polygon parts;
    0 for points and lines."""
    g = _sql(geom)
    return F.expr(f"CASE WHEN {g}.gtype LIKE '%POLYGON' THEN "
                  f"aggregate({g}.parts, 0D, (acc4, pp) -> acc4 + {_part_area('pp')}) ELSE 0D END")


def length_m(geom: str) -> Column:
    """Length of every ring / line (perimeter for polygons, holes included), haversine."""
    g = _sql(geom)
    return F.expr(f"aggregate(flatten({g}.parts), 0D, (acc5, rr) -> acc5 + {_ring_len('rr')})")


def compactness(perimeter_m, area_m2_) -> Column:
    """Gravelius ratio P / (2·sqrt(π·A)); 1.0 = circle."""
    return _c(perimeter_m) / F.nullif(2 * F.sqrt(F.lit(math.pi) * _c(area_m2_)), F.lit(0.0))


# ---- G5 -------------------------------------------------------------------------------------
def _crossings(r: str, px: str, py: str) -> str:
    a, b = f"{r}[i6]", f"{r}[i6 + 1]"
    return (f"(CASE WHEN size({r}) < 2 THEN 0 ELSE aggregate(sequence(0, size({r}) - 2), 0, (acc6, i6) -> acc6 + "
            f"CASE WHEN (({a}.y > {py}) <> ({b}.y > {py})) AND "
            f"({px} < ({b}.x - {a}.x) * ({py} - {a}.y) / ({b}.y - {a}.y) + {a}.x) THEN 1 ELSE 0 END) END)")


def _on_edge(r: str, px: str, py: str, eps: float) -> str:
    a, b = f"{r}[i7]", f"{r}[i7 + 1]"
    return (f"(size({r}) >= 2 AND exists(sequence(0, size({r}) - 2), i7 -> "
            f"abs(({b}.x - {a}.x) * ({py} - {a}.y) - ({b}.y - {a}.y) * ({px} - {a}.x)) <= {eps} AND "
            f"{px} BETWEEN least({a}.x, {b}.x) - {eps} AND greatest({a}.x, {b}.x) + {eps} AND "
            f"{py} BETWEEN least({a}.y, {b}.y) - {eps} AND greatest({a}.y, {b}.y) + {eps}))")


def contains_point(geom: str, px: str, py: str, eps: float = 1e-12) -> Column:
    """Point in polygon (boundary counts as inside).  Even-odd ray casting over
    every ring of every part handles holes and multipolygons without nesting."""
    g = _sql(geom)
    x, y = _sql(px), _sql(py)
    return F.expr(f"({g}.gtype LIKE '%POLYGON') AND ("
                  f"(aggregate(flatten({g}.parts), 0, (acc8, rr8) -> acc8 + {_crossings('rr8', x, y)}) % 2 = 1) "
                  f"OR exists(flatten({g}.parts), rr9 -> {_on_edge('rr9', x, y, eps)}))")


# ---- G6 ---------------------------------------------------------------------------------------
_UNIT = ("named_struct('x', cos(radians({y})) * cos(radians({x})), 'y', cos(radians({y})) * sin(radians({x})), "
         "'z', sin(radians({y})))")


def _chord_dist(a: str, p: str) -> str:
    """Great-circle metres between two unit vectors."""
    return (f"(2 * {R} * asin(least(1D, sqrt(pow({a}.x - {p}.x, 2) + pow({a}.y - {p}.y, 2) + pow({a}.z - {p}.z, 2)) / 2)))")


def _arc_dist(a: str, b: str, p: str) -> str:
    """Great-circle metres from ``p`` to the shorter arc between ``a`` and
    ``b``: to the arc's plane where ``p`` lies between the planes through its
    ends, else to the nearer end.  Vectors have no antimeridian."""
    normal = (f"named_struct('x', {a}.y * {b}.z - {a}.z * {b}.y, 'y', {a}.z * {b}.x - {a}.x * {b}.z, "
              f"'z', {a}.x * {b}.y - {a}.y * {b}.x)")
    n = "n13"
    after_a = (f"({n}.y * {a}.z - {n}.z * {a}.y) * {p}.x + ({n}.z * {a}.x - {n}.x * {a}.z) * {p}.y + "
               f"({n}.x * {a}.y - {n}.y * {a}.x) * {p}.z")
    before_b = (f"({b}.y * {n}.z - {b}.z * {n}.y) * {p}.x + ({b}.z * {n}.x - {b}.x * {n}.z) * {p}.y + "
                f"({b}.x * {n}.y - {b}.y * {n}.x) * {p}.z")
    size = f"({n}.x * {n}.x + {n}.y * {n}.y + {n}.z * {n}.z)"
    height = f"(({n}.x * {p}.x + {n}.y * {p}.y + {n}.z * {p}.z) / sqrt({size}))"
    return (f"transform(array({normal}), n13 -> CASE WHEN {size} > 1e-24 AND {after_a} >= 0 AND {before_b} >= 0 "
            f"THEN {R} * abs(asin(greatest(-1D, least(1D, {height})))) "
            f"ELSE least({_chord_dist(a, p)}, {_chord_dist(b, p)}) END)[0]")


def _ring_dist(r: str, p: str) -> str:
    """Of a ring given as unit vectors."""
    return (f"(CASE WHEN size({r}) = 1 THEN {_chord_dist(f'{r}[0]', p)} ELSE array_min(transform(sequence(0, size({r}) - 2), "
            f"i10 -> {_arc_dist(f'{r}[i10]', f'{r}[i10 + 1]', p)})) END)")


def distance_to_boundary_m(geom: str, px: str, py: str) -> Column:
    """Shortest great-circle distance (m) from a point to any vertex or edge
    of the geometry's lines or rings; edges are great-circle arcs.  NULL for a
    NULL coordinate and for a geometry without vertices."""
    g = _sql(geom)
    x, y = _sql(px), _sql(py)
    unit = _UNIT.format(x="v13.x", y="v13.y")
    rings = f"transform(filter(flatten({g}.parts), q -> size(q) > 0), rr11 -> transform(rr11, v13 -> {unit}))"
    return F.expr(f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN transform(array({_UNIT.format(x=x, y=y)}), "
                  f"p13 -> array_min(transform({rings}, rr12 -> {_ring_dist('rr12', 'p13')})))[0] END")


def distance_m(geom: str, px: str, py: str) -> Column:
    """0 inside a polygon, else the boundary distance."""
    return F.when(contains_point(geom, px, py), F.lit(0.0)).otherwise(distance_to_boundary_m(geom, px, py))


def haversine_m(lon1, lat1, lon2, lat2) -> Column:
    a = F.pow(F.sin((F.radians(_c(lat2)) - F.radians(_c(lat1))) / 2), 2) + \
        F.cos(F.radians(_c(lat1))) * F.cos(F.radians(_c(lat2))) * \
        F.pow(F.sin((F.radians(_c(lon2)) - F.radians(_c(lon1))) / 2), 2)
    return 2 * R * F.asin(F.sqrt(a))


# ---- bounding box -------------------------------------------------------------------------------
def bbox(geom: str) -> Column:
    g = _sql(geom)
    v = f"flatten(flatten({g}.parts))"
    return F.expr(f"named_struct('xmin', array_min(transform({v}, q -> q.x)), "
                  f"'xmax', array_max(transform({v}, q -> q.x)), "
                  f"'ymin', array_min(transform({v}, q -> q.y)), "
                  f"'ymax', array_max(transform({v}, q -> q.y)))")


def n_vertices(geom: str) -> Column:
    return F.expr(f"size(flatten(flatten({_sql(geom)}.parts)))")


# ---- G8: validity ---------------------------------------------------------------------------------
def _orient(p: str, q: str, r: str) -> str:
    return f"sign(({q}.x - {p}.x) * ({r}.y - {p}.y) - ({q}.y - {p}.y) * ({r}.x - {p}.x))"


def _segs_touch(a: str, b: str, c: str, d: str) -> str:
    d1, d2 = _orient(c, d, a), _orient(c, d, b)
    d3, d4 = _orient(a, b, c), _orient(a, b, d)
    overlap = (f"(greatest(least({a}.x, {b}.x), least({c}.x, {d}.x)) <= least(greatest({a}.x, {b}.x), greatest({c}.x, {d}.x)) "
               f"AND greatest(least({a}.y, {b}.y), least({c}.y, {d}.y)) <= least(greatest({a}.y, {b}.y), greatest({c}.y, {d}.y)))")
    return (f"((({d1}) * ({d2}) < 0 AND ({d3}) * ({d4}) < 0) OR "
            f"((({d1}) * ({d2}) <= 0 AND ({d3}) * ({d4}) <= 0) AND {overlap}))")


def _ring_simple(r: str) -> str:
    n = f"size({r})"
    touch = _segs_touch(f"{r}[i12]", f"{r}[i12 + 1]", f"{r}[j12]", f"{r}[j12 + 1]")
    return (f"NOT exists(sequence(0, {n} - 2), i12 -> exists(filter(sequence(0, {n} - 2), "
            f"j12 -> j12 >= i12 + 2 AND NOT (i12 = 0 AND j12 = {n} - 2)), j12 -> {touch}))")


def validity_reason(geom: str, crossings: bool = True) -> Column:
    """NULL when valid, else the first failed rule: empty, coordinates,
    ring too short, ring not closed, self-intersection.  Edge crossing is
    checked pairwise per ring (O(n²) per ring), or left out; for long rings
    see operators/validity.py."""
    g = _sql(geom)
    verts = f"flatten(flatten({g}.parts))"
    coords_ok = (f"forall({verts}, q -> q.x IS NOT NULL AND q.y IS NOT NULL AND NOT isnan(q.x) AND NOT isnan(q.y) "
                 f"AND q.x BETWEEN -180 AND 180 AND q.y BETWEEN -90 AND 90)")
    is_poly = f"{g}.gtype LIKE '%POLYGON'"
    is_line = f"{g}.gtype LIKE '%LINESTRING'"
    short = (f"exists(flatten({g}.parts), rr -> CASE WHEN {is_poly} THEN size(rr) < 4 "
             f"WHEN {is_line} THEN size(rr) < 2 ELSE size(rr) < 1 END)")
    unclosed = f"({is_poly} AND exists(flatten({g}.parts), rr -> rr[0] <> rr[size(rr) - 1]))"
    crossing = "false" if not crossings else f"({is_poly} AND exists(flatten({g}.parts), rr -> NOT {_ring_simple('rr')}))"
    return F.expr(f"CASE WHEN {g} IS NULL OR size({verts}) = 0 THEN 'empty' "
                  f"WHEN NOT {coords_ok} THEN 'coordinates' WHEN {short} THEN 'ring too short' "
                  f"WHEN {unclosed} THEN 'ring not closed' WHEN {crossing} THEN 'self-intersection' END")


def is_valid(geom: str) -> Column:
    return validity_reason(geom).isNull()


# ---- G13: light repair ---------------------------------------------------------------------------
def repair(geom: str) -> Column:
    """Drop consecutive duplicate vertices and close open polygon rings."""
    g = _sql(geom)
    dedup = ("filter(transform(sequence(0, size(rr) - 1), k -> named_struct('k', k, 'v', rr[k])), "
             "e -> e.k = 0 OR e.v <> rr[e.k - 1])")
    cleaned = f"transform({dedup}, e -> e.v)"
    closed = (f"CASE WHEN {g}.gtype LIKE '%POLYGON' AND size({cleaned}) > 0 AND "
              f"element_at({cleaned}, 1) <> element_at({cleaned}, -1) "
              f"THEN concat({cleaned}, array(element_at({cleaned}, 1))) ELSE {cleaned} END")
    return F.expr(f"named_struct('gtype', {g}.gtype, 'parts', transform({g}.parts, pp -> "
                  f"transform(pp, rr -> {closed})))")


# ---- G14: geometry -> WKT --------------------------------------------------------------------------
def as_wkt(geom: str) -> Column:
    g = _sql(geom)
    vtxt = "array_join(transform({r}, q -> concat(CAST(q.x AS STRING), ' ', CAST(q.y AS STRING))), ', ')"
    ring = "concat('(', " + vtxt.format(r="rr") + ", ')')"
    part = f"concat('(', array_join(transform(pp, rr -> {ring}), ', '), ')')"
    return F.expr(
        f"CASE {g}.gtype "
        f"WHEN 'POINT' THEN concat('POINT (', {vtxt.format(r=f'{g}.parts[0][0]')}, ')') "
        f"WHEN 'LINESTRING' THEN concat('LINESTRING (', {vtxt.format(r=f'{g}.parts[0][0]')}, ')') "
        f"WHEN 'POLYGON' THEN concat('POLYGON ', aggregate(slice({g}.parts, 1, 1), '', (s, pp) -> {part})) "
        f"WHEN 'MULTILINESTRING' THEN concat('MULTILINESTRING (', array_join(transform({g}.parts, pp -> "
        f"concat('(', {vtxt.format(r='pp[0]')}, ')')), ', '), ')') "
        f"WHEN 'MULTIPOLYGON' THEN concat('MULTIPOLYGON (', array_join(transform({g}.parts, pp -> {part}), ', '), ')') "
        f"END")


# ---- G12: inverse Albers equal-area conic (EPSG:5070, GRS80) ------------------------------------------
# FIXED VALUES: NAD83 / Conus Albers parameters
ALBERS_5070 = dict(a=6378137.0, inv_f=298.257222101, lat1=29.5, lat2=45.5, lat0=23.0, lon0=-96.0,
                   x0=0.0, y0=0.0)


def _albers_constants(p=ALBERS_5070):
    a, f = p["a"], 1.0 / p["inv_f"]
    e2 = 2 * f - f * f
    e = math.sqrt(e2)

    def q(phi):
        s = math.sin(phi)
        return (1 - e2) * (s / (1 - e2 * s * s) - (1 / (2 * e)) * math.log((1 - e * s) / (1 + e * s)))

    def m(phi):
        s = math.sin(phi)
        return math.cos(phi) / math.sqrt(1 - e2 * s * s)

    p1, p2, p0 = (math.radians(p[k]) for k in ("lat1", "lat2", "lat0"))
    n = (m(p1) ** 2 - m(p2) ** 2) / (q(p2) - q(p1))
    C = m(p1) ** 2 + n * q(p1)
    rho0 = a * math.sqrt(C - n * q(p0)) / n
    qp = q(math.pi / 2)
    return dict(a=a, e2=e2, e=e, n=n, C=C, rho0=rho0, qp=qp, lon0=p["lon0"], x0=p["x0"], y0=p["y0"], q=q)


def albers_to_lonlat(x, y, params=ALBERS_5070) -> Column:
    """Projected metres -> struct(x=lon, y=lat) via the authalic-latitude series."""
    k = _albers_constants(params)
    a, e2, n, C, rho0, qp = k["a"], k["e2"], k["n"], k["C"], k["rho0"], k["qp"]
    X = _c(x) - k["x0"]
    Y = _c(y) - k["y0"]
    rho = F.sqrt(X * X + (F.lit(rho0) - Y) * (F.lit(rho0) - Y))
    theta = F.atan2(X, F.lit(rho0) - Y)
    qv = (F.lit(C) - rho * rho * (n * n) / (a * a)) / n
    beta = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), qv / qp)))
    e4, e6 = e2 * e2, e2 * e2 * e2
    phi = (beta + (e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta)
           + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta)
           + (761 * e6 / 45360) * F.sin(6 * beta))
    lon = F.lit(k["lon0"]) + F.degrees(theta / n)
    return F.struct(lon.alias("x"), F.degrees(phi).alias("y"))


def lonlat_to_albers(lon, lat, params=ALBERS_5070) -> Column:
    """Degrees -> struct(x, y) in projected metres, the inverse of :func:`albers_to_lonlat`."""
    k = _albers_constants(params)
    a, e, e2, n = k["a"], k["e"], k["e2"], k["n"]
    s = F.sin(F.radians(_c(lat)))
    q = (1 - e2) * (s / (1 - e2 * s * s) - F.log((1 - e * s) / (1 + e * s)) / (2 * e))
    rho = F.sqrt(F.greatest(F.lit(0.0), F.lit(k["C"]) - n * q)) * (a / n)
    theta = F.radians(_c(lon) - k["lon0"]) * n
    return F.struct((rho * F.sin(theta) + k["x0"]).alias("x"), (F.lit(k["rho0"]) - rho * F.cos(theta) + k["y0"]).alias("y"))


def map_vertices(geom, fn) -> Column:
    """The geometry with ``fn(vertex)`` in place of each vertex of every part and ring."""
    g = F.col(geom) if isinstance(geom, str) else geom
    parts = F.transform(g["parts"], lambda p: F.transform(p, lambda r: F.transform(r, fn)))
    return F.when(g.isNotNull(), F.struct(g["gtype"].alias("gtype"), parts.alias("parts")))


def densify(geom, max_edge: float) -> Column:
    """The geometry with vertices added along each edge longer than
    ``max_edge`` (in its own units), evenly spaced: a straight edge is curved
    in another projection.  Old vertices stay as they are; an edge with a NULL
    coordinate, a single vertex and an empty ring are left alone."""
    if not max_edge > 0:
        raise ValueError("max_edge is above 0")
    g = F.col(geom) if isinstance(geom, str) else geom

    def edge(a, b):
        dx, dy = b["x"] - a["x"], b["y"] - a["y"]
        pieces = F.greatest(F.lit(1), F.coalesce(F.ceil(F.sqrt(dx * dx + dy * dy) / max_edge), F.lit(1)).cast("int"))
        at = lambda j: F.struct((a["x"] + dx * j / pieces).alias("x"), (a["y"] + dy * j / pieces).alias("y"))
        return F.transform(F.sequence(F.lit(0), pieces - 1), lambda j: F.when(j == 0, a).otherwise(at(j)))

    def ring(r):
        inner = F.flatten(F.transform(F.sequence(F.lit(0), F.size(r) - 2), lambda i: edge(F.get(r, i), F.get(r, i + 1))))
        return F.when(F.size(r) < 2, r).otherwise(F.concat(inner, F.slice(r, -1, 1)))

    parts = F.transform(g["parts"], lambda p: F.transform(p, ring))
    return F.when(g.isNotNull(), F.struct(g["gtype"].alias("gtype"), parts.alias("parts")))


def reproject(geom, to: str = "lonlat", max_edge: float | None = None, params=ALBERS_5070) -> Column:
    """G12 for whole geometries: points, lines, rings and their multiples from
    projected metres to degrees (``lonlat``) or back (``albers``); with
    ``max_edge`` (units of the input) edges are densified first."""
    if to not in ("lonlat", "albers"):
        raise ValueError("to is 'lonlat' or 'albers'")
    turn = albers_to_lonlat if to == "lonlat" else lonlat_to_albers
    given = densify(geom, max_edge) if max_edge is not None else geom
    return map_vertices(given, lambda v: turn(v["x"], v["y"], params))
