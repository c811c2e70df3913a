"""G5, G7, G9-G11 as distributed joins.

Spark has no spatial index, and a theta join (``st_intersects``) plans as a
nested loop over all pairs.  Instead geometries become grid cells, points know
their cells, and the join is an equi-join on the cell (shuffle or broadcast as
AQE decides; a hot cell is split by AQE's skew-join handling), followed by an
exact test where the cell leaves it open.  No pair is produced twice.
"""

from __future__ import annotations

import logging
import math
import time

from pyspark.sql import Column, DataFrame, Window, functions as F

log = logging.getLogger("fieldlake.spatial")

from ..constants import EARTH_RADIUS_M
from ..functions import geo
from . import cover
from ..session import ensure_checkpoint_dir

DEG_M = math.pi / 180.0 * EARTH_RADIUS_M
MIN_STEPS = 32   # lattice rows and columns of a basin, at least


def _cells_of_box(xmin: Column, xmax: Column, ymin: Column, ymax: Column, cell: float) -> Column:
    """array<struct<cx,cy>> of the grid cells a box covers."""
    xs = F.sequence(F.floor(xmin / cell).cast("long"), F.floor(xmax / cell).cast("long"))
    ys = F.sequence(F.floor(ymin / cell).cast("long"), F.floor(ymax / cell).cast("long"))
    return F.flatten(F.transform(xs, lambda i: F.transform(ys, lambda j: F.struct(i.alias("cx"), j.alias("cy")))))


def point_cells(points: DataFrame, px: str, py: str, cell: float) -> DataFrame:
    return (points.withColumn("_cx", F.floor(F.col(px) / cell).cast("long"))
                  .withColumn("_cy", F.floor(F.col(py) / cell).cast("long")))


def spatial_join(points: DataFrame, polys: DataFrame, px: str, py: str, geom_col: str,
                 cell: float | None = None, geom_id: str | None = None) -> DataFrame:
    """(point, polygon) pairs where the polygon contains the point
    (boundary inside).  Output: all point columns + all polygon columns.

    Polygons are covered with cells (see cover.py); a point asks for its cell
    of every level in use and finds at most one cell of a polygon.  In an
    inside cell it is a hit, in a boundary cell the exact test decides, for
    which the polygon is fetched by ``geom_id`` (unique; else a hash of the
    geometry stands in, and equal geometries share their cells).  ``cell`` is
    no longer needed: cells follow each polygon's size."""
    ensure_checkpoint_dir(points.sparkSession)
    # geometries are read several times: written once, so that none is parsed again
    keyed = polys.withColumn("_gid", F.xxhash64(geom_col) if geom_id is None else F.col(geom_id)).checkpoint()
    shapes = keyed.select("_gid", geom_col)
    shapes = shapes.dropDuplicates(["_gid"]) if geom_id is None else shapes
    used = cover.levels(shapes, geom_col) or [0]
    cell = f"struct(k AS level, {cover.cell_of(f'`{px}`', 'k')} AS cx, {cover.cell_of(f'`{py}`', 'k')} AS cy)"
    probes = (points.filter(F.col(px).isNotNull() & F.col(py).isNotNull())
                    .withColumn("_cell", F.expr(f"explode(transform(sequence({used[0]}, {used[-1]}, {cover.STEP}), k -> {cell}))")))
    cells = cover.cover(shapes, "_gid", geom_col).select(F.col("_gid").alias("_g"), F.struct("level", "cx", "cy").alias("_c"), "inside")
    hits = probes.join(cells, F.col("_cell") == F.col("_c")).drop("_cell", "_c").withColumnRenamed("inside", "_inside")
    j = hits.join(keyed, F.col("_g") == F.col("_gid"))
    return j.filter(F.col("_inside") | geo.contains_point(geom_col, px, py)).drop("_g", "_gid", "_inside")


def assign_to_boxes(points: DataFrame, boxes: DataFrame, px: str, py: str,
                    xmin: str, xmax: str, ymin: str, ymax: str, cell: float = 1.0) -> DataFrame:
    """Tag each point with every box (inclusive) that contains it."""
    pts = point_cells(points, px, py, cell)
    bx = boxes.withColumn("_cell", F.explode(_cells_of_box(F.col(xmin), F.col(xmax), F.col(ymin), F.col(ymax), cell)))
    bx = bx.withColumn("_cx", F.col("_cell.cx")).withColumn("_cy", F.col("_cell.cy")).drop("_cell")
    j = pts.join(bx, on=["_cx", "_cy"], how="inner")
    return j.filter(F.col(px).between(F.col(xmin), F.col(xmax))
                    & F.col(py).between(F.col(ymin), F.col(ymax))).drop("_cx", "_cy")


def _level_cells(lon: Column, lat: Column, k: int) -> tuple[Column, Column]:
    """Column and row of a position in the grid of 2**k columns around the globe."""
    size = 360.0 / (1 << k)
    return (F.pmod(F.floor((lon + 180.0) / size).cast("long"), F.lit(1 << k).cast("long")), F.floor((lat + 90.0) / size).cast("long"))


def _vector(lon: Column, lat: Column, name: str) -> list[Column]:
    """Unit vector of a position, as three columns."""
    lon, lat = F.radians(lon), F.radians(lat)
    return [(F.cos(lat) * F.cos(lon)).alias(f"{name}x"), (F.cos(lat) * F.sin(lon)).alias(f"{name}y"), F.sin(lat).alias(f"{name}z")]


def _edge_vectors(geoms: DataFrame, geom_id: str, geom_col: str) -> DataFrame:
    """Every edge, and every vertex that is alone in its ring, as unit vectors
    of its ends and the normal of its plane, with its box."""
    twice = F.expr(f"struct(transform(`{geom_col}`.parts, p -> transform(p, r -> CASE WHEN size(r) = 1 THEN array(r[0], r[0]) ELSE r END)) AS parts)")
    e = cover.edges(geoms.select(geom_id, twice.alias("_g")), geom_id, "_g").select(geom_id, "ax", "ay", "bx", "by")
    v = e.select("*", *_vector(F.col("ax"), F.col("ay"), "u"), *_vector(F.col("bx"), F.col("by"), "v"))
    cross = {"nx": "uy * vz - uz * vy", "ny": "uz * vx - ux * vz", "nz": "ux * vy - uy * vx"}
    return v.withColumns({c: F.expr(x) for c, x in cross.items()})


def _edge_level_cells(e: DataFrame, k: int) -> DataFrame:
    """Each edge in the cells its box covers; the box is raised by what a
    great-circle edge as wide as the box can bulge."""
    size = 360.0 / (1 << k)
    west, east, low, high = F.least("ax", "bx"), F.greatest("ax", "bx"), F.least("ay", "by"), F.greatest("ay", "by")
    width = F.radians(F.least(east - west, F.lit(180.0)))
    bulge = F.degrees(width * width / 16)
    x0, x1 = (F.floor((c + 180.0) / size).cast("long") for c in (west, east))
    y0 = F.floor((F.greatest(F.lit(-90.0), low - bulge) + 90.0) / size).cast("long")
    y1 = F.floor((F.least(F.lit(90.0), high + bulge) + 90.0) / size).cast("long")
    around = F.array_distinct(F.transform(F.sequence(x0, F.least(x1, x0 + (1 << k))), lambda i: F.pmod(i, F.lit(1 << k).cast("long"))))
    return e.withColumn("_cx", F.explode(around)).withColumn("_cy", F.explode(F.sequence(y0, y1)))


#: metres from (px, py, pz) to an edge's arc: to its plane where the point lies between the planes through its ends, else to the nearer end
_ARC_M = f"""
CASE WHEN nx * nx + ny * ny + nz * nz > 1e-24
          AND (ny * uz - nz * uy) * px + (nz * ux - nx * uz) * py + (nx * uy - ny * ux) * pz >= 0
          AND (vy * nz - vz * ny) * px + (vz * nx - vx * nz) * py + (vx * ny - vy * nx) * pz >= 0
     THEN {EARTH_RADIUS_M} * abs(asin(greatest(-1D, least(1D, (nx * px + ny * py + nz * pz) / sqrt(nx * nx + ny * ny + nz * nz)))))
     ELSE {2 * EARTH_RADIUS_M} * asin(least(1D, sqrt(least((ux - px) * (ux - px) + (uy - py) * (uy - py) + (uz - pz) * (uz - pz),
                                                          (vx - px) * (vx - px) + (vy - py) * (vy - py) + (vz - pz) * (vz - pz))) / 2)) END"""


def nearest_geometries(points: DataFrame, geoms: DataFrame, point_id: str, geom_id: str, px: str, py: str,
                       geom_col: str, k: int = 1, cell: float = 1.0, inside_is_zero: bool = False) -> DataFrame:
    """(point_id, rank, geom_id, distance_m): for every point the ``k``
    geometries at the smallest great-circle distances (ties to the smaller
    ``geom_id``), all of them where there are fewer.

    Edges, not geometries, are looked up: a point meets the edges in its cell
    and the eight around it, in a grid that begins near ``cell`` degrees and
    doubles each round; columns wrap around the globe.  A point is settled once
    its k-th candidate lies nearer than anything outside those nine cells can,
    and in the last round, whose cells hold the whole world, in any case.  Each
    round is checkpointed to the shared folder.  A point without coordinates
    has no rows."""
    ensure_checkpoint_dir(points.sparkSession)
    shapes = geoms.select(geom_id, geom_col)
    located = points.filter(F.col(px).isNotNull() & F.col(py).isNotNull()).select(point_id, F.col(px).alias("_lon"), F.col(py).alias("_lat"))
    edges = _edge_vectors(shapes, geom_id, geom_col).checkpoint()
    inside = None
    if inside_is_zero:
        inside = spatial_join(located, shapes, "_lon", "_lat", geom_col, geom_id=geom_id).select(point_id, geom_id, F.lit(0.0).alias("distance_m")).checkpoint()
    pending, settled = located, None
    for level in range(max(1, math.floor(math.log2(360.0 / cell))), 0, -1):
        t0 = time.perf_counter()
        size = 360.0 / (1 << level)
        cx, cy = _level_cells(F.col("_lon"), F.col("_lat"), level)
        probes = (pending.select(point_id, *_vector(F.col("_lon"), F.col("_lat"), "p"), cx.alias("_x"), cy.alias("_y"))
                         .withColumn("_cx", F.expr(f"explode(array_distinct(array(pmod(_x - 1, {1 << level}L), _x, pmod(_x + 1, {1 << level}L))))"))
                         .withColumn("_cy", F.expr("explode(array(_y - 1, _y, _y + 1))")).drop("_x", "_y"))
        met = (probes.join(_edge_level_cells(edges, level), ["_cx", "_cy"])
                     .select(point_id, geom_id, F.expr(_ARC_M).alias("distance_m")))
        if inside is not None:
            met = met.unionByName(inside.join(pending.select(point_id), point_id, "left_semi"))
        met = met.groupBy(point_id, geom_id).agg(F.min("distance_m").alias("distance_m"))
        own = Window.partitionBy(point_id)
        best = met.withColumn("rank", F.row_number().over(own.orderBy("distance_m", geom_id))).filter(F.col("rank") <= k)
        best = best.withColumn("_have", F.count("*").over(own)).withColumn("_far", F.max("distance_m").over(own))
        # nearest thing outside the nine cells: a row away, or across a meridian a column away
        across = F.asin(F.cos(F.radians("_lat")) * F.sin(F.radians(F.lit(min(size, 90.0)))))
        guard = EARTH_RADIUS_M * F.least(F.radians(F.lit(size)), across)
        ok = F.lit(True) if level == 1 else F.coalesce((F.col("_have") >= k) & (F.col("_far") <= guard), F.lit(False))
        state = pending.join(best, point_id, "left").withColumn("_ok", ok).drop("_have", "_far").checkpoint()
        done_now = state.filter("_ok AND rank IS NOT NULL").select(point_id, "rank", geom_id, "distance_m")
        settled = done_now if settled is None else settled.unionByName(done_now)
        pending = state.filter("NOT _ok AND (rank IS NULL OR rank = 1)").select(point_id, "_lon", "_lat")
        done = pending.isEmpty()
        log.debug("nearest_geometries: cells of %.4f degrees done in %.2fs, unsettled left: %s", size, time.perf_counter() - t0, not done)
        if done:
            break
    return settled


def nearest_geometry(points: DataFrame, geoms: DataFrame, point_id: str, geom_id: str, px: str, py: str,
                     geom_col: str, cell: float = 1.0, inside_is_zero: bool = False) -> DataFrame:
    """G7 with k = 1, one row for every point: one without coordinates, and
    every one when there are no geometries, keeps NULL for both columns."""
    near = nearest_geometries(points, geoms, point_id, geom_id, px, py, geom_col, 1, cell, inside_is_zero)
    return points.select(point_id).join(near.drop("rank"), point_id, "left")


def overlap_percent(basins: DataFrame, burns: DataFrame, basin_id: str, basin_geom: str, burn_geom: str,
                    resolution: float = 0.01, cell: float = 1.0, min_steps: int = MIN_STEPS) -> DataFrame:
    """area(basin ∩ any burn) / area(basin) × 100 by grid sampling.

    The basin's bounding box is covered by a lattice of ``resolution``
    degrees; lattice centres inside the basin are weighted by cos(lat) (area
    element) and tested against the burns with the grid spatial join.
    Error shrinks with the resolution (about one lattice cell along the
    boundary); a small basin gets a finer lattice of its own.  A basin where
    nothing could be sampled (no area) gives NULL."""
    b = basins.select(basin_id, basin_geom).withColumn("_bb", geo.bbox(basin_geom))
    b = b.filter(F.col("_bb.xmin").isNotNull())
    # at least min_steps lattice rows and columns, so a basin below one step is sampled too
    wide, high = F.col("_bb.xmax") - F.col("_bb.xmin"), F.col("_bb.ymax") - F.col("_bb.ymin")
    nx = F.greatest(F.ceil(wide / resolution), F.lit(min_steps)).cast("long")
    ny = F.greatest(F.ceil(high / resolution), F.lit(min_steps)).cast("long")
    b = b.withColumn("_sx", F.least(F.lit(resolution), wide / min_steps)).withColumn("_sy", F.least(F.lit(resolution), high / min_steps))
    # explode lattice rows first and spread them over tasks before exploding
    # columns, so one large basin is not generated inside a single task
    rows_ = (b.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), nx - 1)))
              .withColumn("_ny", ny)
              .repartition(basin_id, "_i"))
    lat = (rows_.withColumn("_j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_ny") - 1)))
             .withColumn("_lx", F.col("_bb.xmin") + (F.col("_i") + 0.5) * F.col("_sx"))
             .withColumn("_ly", F.col("_bb.ymin") + (F.col("_j") + 0.5) * F.col("_sy")))
    inside = (lat.filter(geo.contains_point(basin_geom, "_lx", "_ly"))
                 .select(basin_id, "_i", "_j", "_lx", "_ly", F.cos(F.radians("_ly")).alias("_w")))
    burned = (spatial_join(inside, burns.select(burn_geom), "_lx", "_ly", burn_geom, cell)
              .select(basin_id, "_i", "_j", "_w").dropDuplicates([basin_id, "_i", "_j"]))
    # both sums over the same rows in the same order: a basin burned throughout gives 100 exactly
    seen = inside.join(burned.select(basin_id, "_i", "_j", F.lit(True).alias("_b")), [basin_id, "_i", "_j"], "left")
    sums = seen.groupBy(basin_id).agg(F.sum("_w").alias("_tot"), F.sum(F.when(F.col("_b"), F.col("_w")).otherwise(0.0)).alias("_hit"))
    return (basins.select(basin_id).join(sums, basin_id, "left")
                  .select(basin_id, F.when(F.coalesce("_tot", F.lit(0.0)) > 0,
                                           F.coalesce("_hit", F.lit(0.0)) / F.col("_tot") * 100)
                          .alias("pct_burned")))


def _near(burns: DataFrame, basins: DataFrame, burn_geom: str, basin_geom: str, level: int) -> DataFrame:
    """The burns whose box shares a cell of ``level`` with a basin's."""
    def boxes(df, geom_col, *keep):
        b = df.select(*keep, geo.bbox(geom_col).alias("_b")).filter("_b.xmin IS NOT NULL")
        span = lambda c: F.expr(f"explode(sequence({cover.cell_of(f'_b.{c}min', str(level))}, {cover.cell_of(f'_b.{c}max', str(level))}))")
        return b.withColumn("_bx", span("x")).withColumn("_by", span("y")).drop("_b")
    ids = boxes(burns, burn_geom, "_burn").join(boxes(basins, basin_geom).distinct(), ["_bx", "_by"], "left_semi").select("_burn").distinct()
    return burns.join(ids, "_burn", "left_semi")


def _cells_with_middles(geoms: DataFrame, geom_id: str, geom_col: str, level: int, low: int) -> DataFrame:
    """The cover at ``level`` with ``hit``: inside, or for a boundary cell whether its middle is."""
    cells = cover.cover(geoms, geom_id, geom_col, finest=level, depth=max(0, level - low))
    s = cover.size_of("level")
    middle = (cells.filter(~F.col("inside")).selectExpr("*", f"(cx + 0.5D) * {s} - 180D AS _mx", f"(cy + 0.5D) * {s} - 180D AS _my")
                   .join(geoms.select(geom_id, geom_col), geom_id).withColumn("hit", geo.contains_point(geom_col, "_mx", "_my")))
    keep = [geom_id, "level", "cx", "cy", "inside", "hit"]
    return cells.filter("inside").withColumn("hit", F.lit(True)).select(*keep).unionByName(middle.select(*keep))


def overlap_within(basins: DataFrame, burns: DataFrame, basin_id: str, basin_geom: str, burn_geom: str,
                   max_error: float = 0.5, start: int | None = None, finest: int = 18) -> DataFrame:
    """(basin_id, pct_burned, error_bound, level): the share of each
    basin that lies in any burn, in percent, within ``max_error`` points.

    Basins and burns become cells of one grid.  What is covered by inside
    cells of both is counted by its exact area; only where a boundary runs,
    middles of the finest cells decide, and the area of those cells bounds the
    error.  Basins whose bound is too large go on, four times finer, to level
    ``finest`` at most (their bound is returned, too).  Overlapping burns count
    once.  A basin without area gives NULL; ``basin_id`` is unique."""
    ensure_checkpoint_dir(basins.sparkSession)
    pending = basins.select(basin_id, basin_geom).checkpoint()
    burns = burns.select(burn_geom).withColumn("_burn", F.xxhash64(burn_geom)).dropDuplicates(["_burn"]).checkpoint()
    known = cover.levels(pending, basin_geom, 0)
    level = start if start is not None else min([*known, finest]) + 4
    settled, cell = None, ["level", "cx", "cy"]
    while True:
        low = min([*cover.levels(pending, basin_geom, 0), level])
        near = _near(burns, pending, burn_geom, basin_geom, low).checkpoint()
        low_e = min([*cover.levels(near, burn_geom, 0), level])
        low, low_e = (level - (level - x + 1) // 2 * 2 for x in (low, low_e))
        d = _cells_with_middles(pending, basin_id, basin_geom, level, low).checkpoint()
        e = _cells_with_middles(near, "_burn", burn_geom, level, low_e)
        e = e.groupBy(*cell).agg(F.max("inside").alias("e_inside"), F.max("hit").alias("e_hit")).checkpoint()
        # no cell of the union within a larger one that is burned anyway
        sure = e.filter("e_inside").select(*cell)
        held = cover.upward(e.withColumnsRenamed({c: f"_{c}" for c in cell}).withColumns({c: F.col(f"_{c}") for c in cell}), low_e, "_level", "_cx", "_cy", strict=True)
        held = held.join(sure, cell, "left_semi").select(F.col("_level").alias("level"), F.col("_cx").alias("cx"), F.col("_cy").alias("cy")).distinct()
        e = e.join(held, cell, "left_anti").checkpoint()
        own = d.withColumns({"area": cover.area_of("level", "cy")})
        burnt = e.withColumns({"area": cover.area_of("level", "cy")})
        in_larger = (cover.upward(own, min(low, low_e), basin_id, "inside", "hit", "area").join(e, cell)
                          .select(basin_id, "inside", "hit", "e_inside", "e_hit", "area"))
        in_smaller = (cover.upward(burnt, min(low, low_e), "e_inside", "e_hit", "area", strict=True).join(d, cell)
                           .select(basin_id, "inside", "hit", "e_inside", "e_hit", "area"))
        met = (in_larger.unionByName(in_smaller).groupBy(basin_id)
                        .agg(F.sum(F.when(F.col("hit") & F.col("e_hit"), F.col("area")).otherwise(0.0)).alias("_n"),
                             F.sum(F.when(F.col("inside") & F.col("e_inside"), 0.0).otherwise(F.col("area"))).alias("_u")))
        whole = own.groupBy(basin_id).agg(F.sum(F.when(F.col("hit"), F.col("area")).otherwise(0.0)).alias("_t"),
                                          F.sum(F.when(F.col("inside"), 0.0).otherwise(F.col("area"))).alias("_v"))
        n, u, t, v = F.coalesce("_n", F.lit(0.0)), F.coalesce("_u", F.lit(0.0)), F.col("_t"), F.col("_v")
        untouched = (n == 0) & (u == 0) & (t + v > 0)
        share = F.when(untouched, 0.0).when(t > 0, n / t)
        least, most = F.greatest(F.lit(0.0), n - u) / (t + v), F.when(t > v, F.least(F.lit(1.0), (n + u) / F.when(t > v, t - v))).otherwise(1.0)
        bound = F.when(untouched, 0.0).otherwise(F.greatest(share - least, most - share) * 100)
        out = (pending.join(whole, basin_id, "left").join(met, basin_id, "left")
                      .select(basin_id, basin_geom, (share * 100).alias("pct_burned"), bound.alias("error_bound"), F.lit(level).alias("level")))
        last = level + cover.STEP > finest
        # where no middle lies in the basin yet, nothing is known
        out = out.withColumn("_done", F.lit(last) | F.coalesce(F.col("error_bound") <= max_error, F.lit(False))).checkpoint()
        done = out.filter("_done").drop("_done", basin_geom)
        settled = done if settled is None else settled.unionByName(done)
        pending = out.filter(~F.col("_done")).select(basin_id, basin_geom)
        if last or pending.isEmpty():
            return settled
        level += cover.STEP


def point_report(pairs: DataFrame, points: DataFrame, polys: DataFrame, point_id: str, poly_id: str,
                 px: str, py: str, geom_col: str) -> DataFrame:
    """For each requested (point, polygon) pair: inside flag and km to
    the perimeter (0 when inside).  Pairs are given explicitly and joined on
    their ids, so no all-pairs product is formed."""
    j = (pairs.select(point_id, poly_id)
              .join(points.select(point_id, px, py), point_id)
              .join(polys.select(poly_id, geom_col), poly_id))
    return j.select(point_id, poly_id, geo.contains_point(geom_col, px, py).alias("inside"),
                    (geo.distance_m(geom_col, px, py) / 1000.0).alias("distance_km"))
