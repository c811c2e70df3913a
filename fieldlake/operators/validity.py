"""Validity of geometries whose rings may have millions of edges.

Testing every two edges of a ring takes a square of its length.  Here the
edges of a long ring are exploded into grid cells about as large as an edge,
and only edges that share a cell are tested.  Where a cell holds many edges it
is split, and only there; so a few long edges amid many short ones cost
nothing elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import geo
from ..session import ensure_checkpoint_dir
from . import cover

PAIRWISE = 64     # vertices up to which a ring's edges are tested two by two in its row
CROWDED = 64      # edges beyond which a cell is split


def _mean_edge(ring: str) -> str:
    """Mean over a ring's edges of the larger of width and height."""
    step = f"greatest(abs({ring}[i].x - {ring}[i - 1].x), abs({ring}[i].y - {ring}[i - 1].y))"
    return f"(aggregate(sequence(1, size({ring}) - 1), 0D, (s, i) -> s + {step}) / (size({ring}) - 1))"


def crossing_rings(geoms: DataFrame, geom_id: str, geom_col: str, longer_than: int = 0, crowded: int = CROWDED) -> DataFrame:
    """(geom_id, ring) of the closed rings, of more than ``longer_than``
    vertices, two of whose edges touch though they are not neighbours."""
    ensure_checkpoint_dir(geoms.sparkSession)
    rings = geoms.select(geom_id, F.posexplode(F.flatten(F.col(f"{geom_col}.parts"))).alias("_ring", "_r")).filter((F.size("_r") > longer_than) & (F.size("_r") > 1))
    level = F.floor(F.log2(F.lit(180.0) / F.greatest(F.expr(_mean_edge("_r")), F.lit(1e-9)))).cast("int")
    rings = rings.select(geom_id, F.col("_ring").alias("_no"), F.greatest(F.lit(0), F.least(F.lit(cover.FINEST), level)).alias("level"),
                         F.struct(F.array(F.array("_r")).alias("parts")).alias("_g"))
    keys = [geom_id, "_no"]
    e = cover.edges(rings, geom_id, "_g", "_no", "level")
    columns = [*keys, "i", "n", "ax", "ay", "bx", "by"]
    cells = cover.edge_cells(e, "level", *columns).drop("crosses").checkpoint()
    found = cells.select(*keys).limit(0)
    cell = [*keys, "level", "cx", "cy"]
    touch = F.expr(geo._segs_touch("a", "b", "c", "d"))
    while True:
        full = cells.groupBy(*cell).agg(F.count("*").alias("_n"))
        last = cells.agg(F.min("level")).first()[0]
        split = last is not None and last < cover.FINEST + 4 * cover.STEP
        tested = cells.join(full.filter(F.col("_n") <= crowded), cell) if split else cells
        one = tested.select(*cell, "i", "n", F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")).alias("a"), F.struct(F.col("bx").alias("x"), F.col("by").alias("y")).alias("b"))
        two = tested.select(*cell, F.col("i").alias("j"), F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")).alias("c"), F.struct(F.col("bx").alias("x"), F.col("by").alias("y")).alias("d"))
        apart = (F.col("j") >= F.col("i") + 2) & ~((F.col("i") == 0) & (F.col("j") == F.col("n") - 1))
        found = found.unionByName(one.join(two, cell).filter(apart & touch).select(*keys).distinct()).checkpoint()
        if not split:
            return found.distinct()
        # crowded cells of rings not yet found are split
        rest = cells.join(full.filter(F.col("_n") > crowded).drop("_n"), cell, "left_semi").join(found.distinct(), keys, "left_anti")
        rest = rest.withColumn("level", F.col("level") + cover.STEP).withColumnsRenamed({"cx": "_px", "cy": "_py"})
        cells = cover.edge_cells(rest, "level", *columns, parent=True).drop("crosses").checkpoint()
        if cells.isEmpty():
            return found.distinct()


def reasons(geoms: DataFrame, geom_id: str, geom_col: str, pairwise: int = PAIRWISE) -> DataFrame:
    """(geom_id, reason): NULL for a valid geometry, else the first failed
    rule, as ``geo.validity_reason`` names it; ``geom_id`` is unique.  Rings of
    up to ``pairwise`` vertices are tested in their row, longer ones by cells."""
    longest = F.expr(f"coalesce(array_max(transform(flatten(`{geom_col}`.parts), r -> size(r))), 0)")
    short = longest <= pairwise
    g = geoms.select(geom_id, geom_col, short.alias("_short"),
                     F.when(short, geo.validity_reason(geom_col)).otherwise(geo.validity_reason(geom_col, crossings=False)).alias("reason"))
    long = g.filter(~F.col("_short") & F.col("reason").isNull() & F.col(f"{geom_col}.gtype").like("%POLYGON"))
    # one long ring makes all rings of the geometry go this way
    crossing = crossing_rings(long, geom_id, geom_col).select(F.col(geom_id).alias("_id")).distinct().withColumn("_hit", F.lit(True))
    return (g.select(geom_id, "reason").join(crossing, F.col(geom_id) == F.col("_id"), "left")
             .select(geom_id, F.when(F.col("_hit"), "self-intersection").otherwise(F.col("reason")).alias("reason")))
