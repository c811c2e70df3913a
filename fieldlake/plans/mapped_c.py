"""Driver-table queries for stored tables, file round trips, units and
alternative keys: each reads a whole table and calls the library function."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from ..functions import geo, shape
from ..operators import incremental
from ..operators.windows import RANGES, series_features
from ..schemas import struct
from ..session import shared_path
from ..sources import geojson, ordered, raw, tables, typed
from .tables import read


def _scratch(spark, name: str) -> str:
    return shared_path(spark, f"{name}-{uuid.uuid4().hex}")


def merge_stored(spark, sf) -> DataFrame:
    """I1 on a stored table: orders by status, then changed prices and new
    keys merged twice (a replayed batch) into the touched partitions."""
    o = read(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = _scratch(spark, "merge-stored")
    incremental.merge_into_path(spark, path, o.filter("o_orderkey % 5 <> 0"), "o_orderkey", "o_orderstatus")
    late = (o.filter("o_orderstatus = 'F' AND o_orderkey % 2 = 0")
            .withColumn("o_totalprice", F.col("o_totalprice") + 1.0).withColumn("revision", F.lit(1)))
    for _ in range(2):
        incremental.merge_into_path(spark, path, late, "o_orderkey", "o_orderstatus")
    return incremental.read_stored(spark, path, late, "o_orderstatus").select("o_orderkey", "o_totalprice", "o_orderstatus", "revision")


def full_refresh(spark, sf) -> DataFrame:
    """The incremental pattern without a target keeps every staged row."""
    o = read(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return incremental.incremental_model(None, o, "o_orderkey", "o_orderdate", 14,
                                         lambda d: d.withColumn("year", F.year("o_orderdate").cast("long")))


def batch_reload(spark, sf) -> DataFrame:
    """Only the rows of the named batches (return flags as batch ids)."""
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return incremental.batch_slice(li, "l_returnflag", ["A", "R"])


def alternative_keys(spark, sf) -> DataFrame:
    """P2 + P4: a payload whose unit stands under one of two keys, one of them quoted."""
    p = read(spark, sf, "part")
    key = F.when(F.col("p_partkey") % 2 == 0, "Result/Unit.Code").otherwise("unit")
    payload = F.parse_json(F.to_json(F.create_map(key, F.col("p_type"), F.lit("size"), F.col("p_size").cast("string"))))
    v = p.select("p_partkey", payload.alias("payload"))
    return v.select("p_partkey", shape.first_present("payload", ["Result/Unit.Code", "unit"]).alias("unit"),
                    shape.variant_field("payload", "Result/Unit.Code").alias("quoted"),
                    shape.variant_field("payload", "size", "int").alias("size"))


def unit_conversions(spark, sf) -> DataFrame:
    """Units, the parameter's unit, and the relative difference."""
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    code = F.element_at(F.array(*map(F.lit, ("00060", "00065", "00010", "99999"))), (F.col("l_linenumber") % 4 + 1).cast("int"))
    return li.select("l_orderkey", "l_linenumber", shape.sq_m_to_acres("l_extendedprice").alias("acres"),
                     shape.sq_m_to_sq_miles("l_extendedprice").alias("sq_miles"), shape.lb_to_tons("l_extendedprice").alias("tons"),
                     shape.cfs_days_to_acre_feet("l_quantity").alias("acre_feet"), shape.unit_for_parameter(code).alias("unit"),
                     shape.relative_difference("l_extendedprice", F.col("l_quantity") - 25).alias("relative"))


def ndjson_round_trip(spark, sf) -> DataFrame:
    """Rows to NDJSON, landed as raw payloads in two appends, projected back."""
    c = read(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    landing, bronze = _scratch(spark, "landing"), _scratch(spark, "bronze")
    raw.write_ndjson(c, landing)
    for batch in ("b1", "b2"):
        raw.append_bronze(raw.read_raw_json(spark, landing, batch, "2024-01-01 00:00:00"), bronze)
    b = spark.read.parquet(bronze)
    return b.select(shape.variant_field("payload", "c_custkey", "long").alias("c_custkey"), shape.variant_field("payload", "c_name").alias("c_name"),
                    shape.variant_field("payload", "c_acctbal", "double").alias("c_acctbal"), F.col("_batch_id").alias("batch"))


def csv_round_trip(spark, sf) -> DataFrame:
    """A wide CSV written with a header; three typed columns read back by name."""
    path = _scratch(spark, "csv")
    typed.csv_sink(read(spark, sf, "supplier"), path)
    schema = read(spark, sf, "supplier").schema
    return typed.read_typed_csv(spark, path, struct(*[(n, schema[n].dataType) for n in ("s_suppkey", "s_name", "s_acctbal")]))


def clustered_round_trip(spark, sf) -> DataFrame:
    """A clustered table, replaced once, read with a range filter on its key."""
    path = _scratch(spark, "clustered")
    raw.replace_bronze(read(spark, sf, "part").select("p_partkey"), path)
    tables.clustered_write(read(spark, sf, "part").select("p_partkey", "p_size", "p_name"), path, "p_size")
    return spark.read.parquet(path).filter(F.col("p_size").between(10, 30))


def geojson_round_trip(spark, sf) -> DataFrame:
    """Customers as points of a GeoJSON layer, cut into features and parsed again."""
    c = read(spark, sf, "customer").select("c_custkey", "c_name", geo.point_geom(F.col("c_acctbal") / 100, F.col("c_custkey") % 90).alias("g"))
    path = _scratch(spark, "layer")
    geojson.write_geojson(c, path, "g")
    back = geojson.read_geojson(spark, path).withColumn("g", geo.parse_wkt("geom_wkt"))
    v = F.expr("g.parts[0][0][0]")
    return back.select(geojson.property_of("properties", ["custkey", "c_custkey"], "long").alias("c_custkey"),
                       geojson.property_of("properties", ["c_name"]).alias("c_name"), v["x"].alias("lon"), v["y"].alias("lat"))


def series_by_range(spark, sf) -> DataFrame:
    """W1-W3 per user over segments that follow the rows (pieces of a stored range sort)."""
    ev = read(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    s = series_features(ev, "user_id", ["ts", "event_id"], "value", segment=RANGES)
    return s.withColumn("rolling_mean", F.floor(F.col("rolling_mean") * 1000000 + 0.5) / 1000000)


def ordered_positions(spark, sf) -> DataFrame:
    """Line items by price, dearest first, stored in that order; the position of each row."""
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    path = _scratch(spark, "ordered")
    ordered.write_ordered(li, path, [F.col("l_extendedprice").desc_nulls_last(), "l_orderkey", "l_linenumber"])
    return ordered.read_ordered(spark, path)


def reproject_rings(spark, sf) -> DataFrame:
    """G12 on whole geometries: a square of half a degree for each supplier, projected and back again."""
    s = read(spark, sf, "supplier").select("s_suppkey", (F.lit(-96.0) + F.col("s_acctbal") / 1000).alias("x"), (F.lit(37.0) + F.col("s_nationkey") / 10).alias("y"))
    corner = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    ring = F.array(*[corner(dx, dy) for dx, dy in ((0, 0), (0.5, 0), (0.5, 0.5), (0, 0.5), (0, 0))])
    g = s.select("s_suppkey", F.struct(F.lit("POLYGON").alias("gtype"), F.array(F.array(ring)).alias("parts")).alias("g"))
    g = g.withColumn("m", geo.reproject("g", "albers")).withColumn("back", geo.reproject("m"))
    v = g.select("s_suppkey", F.posexplode(F.arrays_zip(*[F.col(f"{n}.parts")[0][0].alias(n) for n in ("g", "m", "back")])).alias("vertex", "v"))
    mm = lambda c: F.floor(F.col(c) * 1000 + 0.5) / 1000
    near = (F.abs(F.col("v.g.x") - F.col("v.back.x")) < 1e-6) & (F.abs(F.col("v.g.y") - F.col("v.back.y")) < 1e-6)
    return v.select("s_suppkey", "vertex", mm("v.m.x").alias("x"), mm("v.m.y").alias("y"), near.alias("returned"))


def _rings_sql() -> str:
    k = geo._albers_constants()
    e, e2, n = k["e"], k["e2"], k["n"]
    return f"""
WITH c AS (SELECT s_suppkey, vertex, -96.0 + s_acctbal / 1000 + dx AS lon, sin(radians(37.0 + s_nationkey / 10.0 + dy)) AS s
  FROM supplier, (VALUES (0, 0.0, 0.0), (1, 0.5, 0.0), (2, 0.5, 0.5), (3, 0.0, 0.5), (4, 0.0, 0.0)) t(vertex, dx, dy)),
r AS (SELECT s_suppkey, vertex, radians(lon - ({k["lon0"]!r}))::DOUBLE * {n!r}::DOUBLE AS theta, {k["a"] / n!r}::DOUBLE * sqrt({k["C"]!r}::DOUBLE - {n!r}::DOUBLE *
  ({1 - e2!r}::DOUBLE * (s / (1 - {e2!r}::DOUBLE * s * s) - ln((1 - {e!r}::DOUBLE * s) / (1 + {e!r}::DOUBLE * s)) / {2 * e!r}::DOUBLE))) AS rho FROM c)
SELECT s_suppkey, vertex, floor(rho * sin(theta) * 1000 + 0.5) / 1000 AS x,
  floor(({k["rho0"]!r}::DOUBLE - rho * cos(theta)) * 1000 + 0.5) / 1000 AS y, true AS returned FROM r"""


QUERIES = {f.__name__: f for f in (merge_stored, full_refresh, batch_reload, alternative_keys, unit_conversions,
                                   ndjson_round_trip, csv_round_trip, clustered_round_trip,
                                   geojson_round_trip, series_by_range, ordered_positions, reproject_rings)}

SQL = {
    "merge_stored": """
SELECT o_orderkey, CASE WHEN late THEN o_totalprice + 1.0 ELSE o_totalprice END AS o_totalprice, o_orderstatus,
  CASE WHEN late THEN 1 END AS revision
FROM (SELECT *, o_orderstatus = 'F' AND o_orderkey % 2 = 0 AS late FROM orders) WHERE late OR o_orderkey % 5 <> 0""",
    "full_refresh": "SELECT o_orderkey, o_orderdate, o_totalprice, CAST(year(o_orderdate) AS BIGINT) AS year FROM orders",
    "batch_reload": "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag IN ('A', 'R')",
    "alternative_keys": """
SELECT p_partkey, p_type AS unit, CASE WHEN p_partkey % 2 = 0 THEN p_type END AS quoted, CAST(p_size AS INTEGER) AS size FROM part""",
    "unit_conversions": """
SELECT l_orderkey, l_linenumber, l_extendedprice / 4046.8564224 AS acres, l_extendedprice / 2589988.11 AS sq_miles,
  l_extendedprice / 2000.0 AS tons, l_quantity * 86400.0 / 43560.0 AS acre_feet,
  CASE l_linenumber % 4 WHEN 0 THEN 'cfs' WHEN 1 THEN 'ft' WHEN 2 THEN 'degC' END AS unit,
  abs(l_extendedprice - (l_quantity - 25)) / nullif(l_quantity - 25, 0) AS relative FROM lineitem""",
    "ndjson_round_trip": """
SELECT c_custkey, c_name, c_acctbal, batch FROM customer, (VALUES ('b1'), ('b2')) t(batch)""",
    "csv_round_trip": "SELECT s_suppkey, s_name, s_acctbal FROM supplier",
    "geojson_round_trip": """
SELECT c_custkey, c_name, c_acctbal / 100 AS lon, CAST(c_custkey % 90 AS DOUBLE) AS lat FROM customer""",
    "series_by_range": """
SELECT user_id, event_id, ts, value, lag(value) OVER w AS prev_value, value - lag(value) OVER w AS change,
  floor((avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)) * 1000000 + 0.5)
  / 1000000 AS rolling_mean
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "reproject_rings": _rings_sql(),
    "ordered_positions": """
SELECT l_orderkey, l_linenumber, l_extendedprice,
  row_number() OVER (ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber) AS position FROM lineitem""",
    "clustered_round_trip": "SELECT p_partkey, p_size, p_name FROM part WHERE p_size BETWEEN 10 AND 30",
}
