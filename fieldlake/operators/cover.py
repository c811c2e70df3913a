"""Polygons as sets of grid cells, without copying their vertices.

The grid of level k has 2**k columns around the globe; a cell of one level
holds sixteen of the next level but one.  A polygon becomes disjoint cells:
*inside* ones, which no edge touches and whose every point is inside, as large
as the grid's levels allow; and, at the polygon's finest level, *boundary*
ones.  Only ids, cell numbers and single edges are shuffled.

Edges are exploded into the cells they run through, row by row.  A cell that
no edge touches lies wholly inside if an odd number of edges crosses the middle
of its (finest) row to the left of it; one running sum along each row decides
that for all cells of all levels."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import geo
from ..session import ensure_checkpoint_dir

STEP = 2          # levels between a cell and those it is split into
DEPTH = 6         # levels between the cell that holds a polygon's box and its finest cells
FINEST = 30
PIECE = 4096      # edges of a ring that are exploded together
BLOCK = 64        # columns and rows of cells that are dealt together
TASK_CELLS = 500_000  # cells that edges run through, a task
PAD = 1e-9        # degrees by which an edge is thickened, so that rounding never loses a cell


def size_of(level: str) -> str:
    """Degrees a side of a cell, as SQL."""
    return f"(360D / pow(2D, {level}))"


def cell_of(degrees: str, level: str) -> str:
    """Number of the column (of a longitude) or row (of a latitude), as SQL."""
    return f"CAST(floor(({degrees} + 180D) / {size_of(level)}) AS BIGINT)"


def edges(geoms: DataFrame, geom_id: str, geom_col: str, *more: str) -> DataFrame:
    """(geom_id, ring, i, n, ax, ay, bx, by, more): the i-th of a ring's n
    edges; rings are numbered through all parts.  Edges with a NULL end are left out."""
    rings = geoms.select(geom_id, *more, F.posexplode(F.flatten(F.col(f"{geom_col}.parts"))).alias("ring", "_r")).filter(F.size("_r") > 1)
    # a piece of a ring at a time: never all edges of a long one as objects
    rings = rings.withColumn("n", F.size("_r") - 1).withColumn("_s", F.expr(f"explode(sequence(0, n - 1, {PIECE}))"))
    size = f"least({PIECE}, n - _s)"
    e = rings.selectExpr(geom_id, *more, "ring", "n", "_s", f"arrays_zip(slice(_r, _s + 1, {size}), slice(_r, _s + 2, {size})) AS _z")
    e = e.select(geom_id, *more, "ring", "n", "_s", F.posexplode("_z").alias("_i", "_e")).withColumn("i", F.col("_s") + F.col("_i"))
    e = e.withColumn("_e", F.struct(F.col("_e")["0"].alias("a"), F.col("_e")["1"].alias("b")))
    return (e.select(geom_id, *more, "ring", "i", "n", F.col("_e.a.x").alias("ax"), F.col("_e.a.y").alias("ay"),
                     F.col("_e.b.x").alias("bx"), F.col("_e.b.y").alias("by"))
             .filter("ax IS NOT NULL AND ay IS NOT NULL AND bx IS NOT NULL AND by IS NOT NULL"))


def _between(first: str, last: str, parent: str | None) -> str:
    """Numbers from first to last; of those only the ones in ``parent``, a cell STEP levels up."""
    if parent is None:
        return f"sequence({first}, {last})"
    first, last = f"greatest({first}, {parent} * {1 << STEP})", f"least({last}, {parent} * {1 << STEP} + {(1 << STEP) - 1})"
    return f"CASE WHEN {first} <= {last} THEN sequence({first}, {last}) END"


def edge_cells(e: DataFrame, level: str, *keep: str, parent: bool = False) -> DataFrame:
    """Each edge in every cell of ``level`` (a column) that it touches, with
    ``crosses``: 1 in the cell where it crosses the middle of the cell's row.
    With ``parent`` only cells of the cell (_px, _py) STEP levels up."""
    s = size_of(level)
    e = e.selectExpr("*", "least(ay, by) AS _low", "greatest(ay, by) AS _high", "CASE WHEN ay <> by THEN (bx - ax) / (by - ay) END AS _slope")
    rows = e.withColumn("cy", F.expr(f"explode({_between(cell_of(f'_low - {PAD}D', level), cell_of(f'_high + {PAD}D', level), '_py' if parent else None)})"))
    x_at = "ax + (least(_high, greatest(_low, {} * " + s + " - 180D)) - ay) * _slope"
    below, above, middle = x_at.format("cy"), x_at.format("(cy + 1)"), x_at.format("(cy + 0.5D)")
    rows = rows.selectExpr("*", f"CASE WHEN _slope IS NULL THEN least(ax, bx) ELSE least({below}, {above}) END AS _left",
                           f"CASE WHEN _slope IS NULL THEN greatest(ax, bx) ELSE greatest({below}, {above}) END AS _right",
                           f"CASE WHEN (ay > (cy + 0.5D) * {s} - 180D) <> (by > (cy + 0.5D) * {s} - 180D) THEN {cell_of(middle, level)} END AS _x")
    return (rows.withColumn("cx", F.expr(f"explode({_between(cell_of(f'_left - {PAD}D', level), cell_of(f'_right + {PAD}D', level), '_px' if parent else None)})"))
                .selectExpr(*keep, level, "cx", "cy", "coalesce(CAST(_x = cx AS INT), 0) AS crosses"))


def holding_level(box: str) -> str:
    """The finest even level whose cells are at least as large as the box, as SQL."""
    side = f"greatest({box}.xmax - {box}.xmin, {box}.ymax - {box}.ymin, 1e-9D)"
    level = f"greatest(0, least({FINEST - DEPTH}, CAST(floor(log2(360D / {side})) AS INT)))"
    return f"({level} - {level} % {STEP})"


def _up(c: str, k: str) -> str:
    """Column or row of the cell k levels up."""
    return f"CAST(floor({c} / pow(2D, {k})) AS BIGINT)"


def _whole(geom_col: str) -> Column:
    """Every ring is closed and no coordinate is missing."""
    return F.expr(f"forall(flatten(`{geom_col}`.parts), r -> size(r) = 0 OR (forall(r, v -> v.x IS NOT NULL AND v.y IS NOT NULL) "
                  f"AND r[0] = r[size(r) - 1]))")


def cover(geoms: DataFrame, geom_id: str, geom_col: str, finest: int | None = None, depth: int = DEPTH) -> DataFrame:
    """(geom_id, level, cx, cy, inside): the disjoint cells of every polygon,
    inside and boundary.  ``geom_id`` is unique.

    The finest cells are of level ``finest``, or ``depth`` levels below the
    cell that holds the polygon's box.  A polygon with an open ring or a
    missing coordinate has no inside cells: all cells of its box are boundary
    ones.  Lines, points and polygons without vertices have no cells."""
    ensure_checkpoint_dir(geoms.sparkSession)
    g = (geoms.filter(F.col(f"{geom_col}.gtype").like("%POLYGON")).select(geom_id, geom_col)
              .withColumn("_box", geo.bbox(geom_col)).filter("_box.xmin IS NOT NULL AND _box.ymin IS NOT NULL"))
    leaf = f"{holding_level('_box')} + {depth}" if finest is None else f"{finest}"
    g = g.withColumn("_leaf", F.expr(f"CAST({leaf} AS INT)")).withColumn("_whole", _whole(geom_col))
    e = edges(g.filter("_whole"), geom_id, geom_col, "_leaf")
    # a polygon's box is no measure of its boundary: count the rows and columns that its edges run through
    side = f"abs({{1}}{{0}} - {{2}}{{0}}) / {size_of('_leaf')}"
    run = e.agg(F.sum(F.expr(f"1 + {side.format('x', 'a', 'b')} + {side.format('y', 'a', 'b')}"))).first()[0] or 0.0
    tasks = max(1, math.ceil(run / TASK_CELLS)) if math.isfinite(run) else 1
    # read three times below: ids and cell numbers, written once; edges are dealt to
    # tasks, then cells, block by block, so that a task's share does not grow with the table
    block = {"_bx": F.floor(F.col("cx") / BLOCK).cast("long"), "_by": F.floor(F.col("cy") / BLOCK).cast("long")}
    border = (edge_cells(e.repartition(tasks, geom_id, "ring", "i"), "_leaf", geom_id).withColumns(block)
              .repartition(tasks, geom_id, "_bx", "_by")
              .groupBy(geom_id, "_leaf", "_bx", "_by", "cx", "cy").agg(F.sum("crosses").alias("n")).drop("_bx", "_by").checkpoint())
    # all cells above the boundary's, k levels up, each with a bit for every cell it is split into that holds an edge
    ks = f"explode(sequence({STEP}, {depth}, {STEP}))" if depth >= STEP else "explode(CAST(NULL AS ARRAY<INT>))"
    side = 1 << STEP
    child = f"(_cx - cx * {side}) + {side} * (_cy - cy * {side})"
    above = (border.withColumn("k", F.expr(ks))
                   .selectExpr(geom_id, "_leaf", "k", f"{_up('cx', 'k')} AS cx", f"{_up('cy', 'k')} AS cy",
                               f"{_up('cx', f'(k - {STEP})')} AS _cx", f"{_up('cy', f'(k - {STEP})')} AS _cy")
                   .groupBy(geom_id, "_leaf", "k", "cx", "cy").agg(F.expr(f"bit_or(shiftleft(1, CAST({child} AS INT)))").alias("_held"))
                   .repartition(tasks, geom_id, "k", "cx", "cy"))   # each is split into up to 16 below
    free = (above.withColumn("_p", F.expr(f"explode(sequence(0, {side * side - 1}))")).filter("(_held & shiftleft(1, _p)) = 0")
                 .selectExpr(geom_id, "_leaf", f"k - {STEP} AS k", f"cx * {side} + _p % {side} AS cx", f"cy * {side} + _p DIV {side} AS cy"))
    line = (border.selectExpr(geom_id, "_leaf", "cy AS row", "cx AS col", "n", "CAST(NULL AS INT) AS k", "cx", "cy")
            .unionByName(free.selectExpr(geom_id, "_leaf", "CAST(cy * pow(2D, k) AS BIGINT) AS row", "CAST(cx * pow(2D, k) AS BIGINT) AS col", "0L AS n", "k", "cx", "cy")))
    line = line.repartition(3 * tasks, geom_id, "row")
    so_far = F.sum("n").over(Window.partitionBy(geom_id, "row").orderBy("col").rowsBetween(Window.unboundedPreceding, 0))
    inside = line.withColumn("_odd", so_far % 2 == 1).filter("k IS NOT NULL AND _odd")
    span = lambda c: f"explode(sequence({cell_of(f'_box.{c}min - {PAD}D', 'level')}, {cell_of(f'_box.{c}max + {PAD}D', 'level')}))"
    box = g.filter(~F.col("_whole")).withColumn("level", F.col("_leaf") - (depth if finest is None else 0))
    box = box.withColumn("cx", F.expr(span("x"))).withColumn("cy", F.expr(span("y")))
    return (inside.selectExpr(geom_id, "_leaf - k AS level", "cx", "cy", "true AS inside")
            .unionByName(border.selectExpr(geom_id, "_leaf AS level", "cx", "cy", "false AS inside"))
            .unionByName(box.selectExpr(geom_id, "level", "cx", "cy", "false AS inside")))


def levels(geoms: DataFrame, geom_col: str, depth: int = DEPTH) -> list[int]:
    """The levels that ``cover`` may use for these polygons."""
    box = geoms.filter(F.col(f"{geom_col}.gtype").like("%POLYGON")).select(geo.bbox(geom_col).alias("_box")).filter("_box.xmin IS NOT NULL")
    held = F.expr(holding_level("_box"))
    low, high = box.agg(F.min(held), F.max(held)).first()
    return list(range(low, high + depth + 1, STEP)) if low is not None else []


def area_of(level: str, cy: str) -> Column:
    """Share of a cell on the sphere, up to a constant factor."""
    s = size_of(level)
    edge = f"sin(radians(least(90D, greatest(-90D, {{}} * {s} - 180D))))"
    return F.expr(f"{s} * ({edge.format(f'({cy} + 1)')} - {edge.format(cy)})")


def upward(cells: DataFrame, low: int, *keep: str, strict: bool = False) -> DataFrame:
    """Each cell as all the cells that hold it, up to level ``low``; itself too unless ``strict``."""
    first = STEP if strict else 0
    ks = f"explode(CASE WHEN level - {low} >= {first} THEN sequence({first}, level - {low}, {STEP}) END)"
    return cells.withColumn("_k", F.expr(ks)).selectExpr(*keep, "level - _k AS level", f"{_up('cx', '_k')} AS cx", f"{_up('cy', '_k')} AS cy")
