"""GeoJSON FeatureCollections in, map layers out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import geo

#: the value that every feature holds once; text files are cut there
_MARK = '"Feature"'
#: members of a collection; those of a collection inside a collection are read from its text
_MEMBERS = "array<struct<type: string, coordinates: string, geometries: string>>"
_FEATURE = ("properties map<string, string>, geometry struct<type: string, coordinates: string, "
            f"geometries: {_MEMBERS}>, _broken string")
#: levels of collections inside collections
_DEPTH = 3


def coordinates_to_wkt(gtype: Column, coords: Column) -> Column:
    """GeoJSON geometry (type + raw coordinates JSON) -> WKT text (2-D; a third
    coordinate is dropped; no coordinates give EMPTY; an unknown type NULL)."""
    num = r"(-?[0-9.]+(?:[eE][-+]?[0-9]+)?)"
    pairs = F.regexp_replace(coords, r"\[\s*" + num + r"\s*,\s*" + num + r"(?:\s*,\s*" + num + r")*\s*\]", "$1 $2")
    txt = F.regexp_replace(F.regexp_replace(F.regexp_replace(pairs, r"\[", "("), r"\]", ")"), r",\s*", ", ")
    up = F.upper(gtype)
    known = up.isin("MULTIPOLYGON", "POLYGON", "MULTILINESTRING", "LINESTRING", "POINT", "MULTIPOINT")
    body = F.when(up == "POINT", F.concat(F.lit("("), txt, F.lit(")"))).otherwise(txt)
    body = F.when(coords.rlike(r"^[\s\[\],]*$"), "EMPTY").otherwise(body)
    return F.when(known, F.concat_ws(" ", up, body))


def _collected(members: Column, depth: int) -> Column:
    def one(g: Column) -> Column:
        plain = coordinates_to_wkt(g["type"], g["coordinates"])
        if depth <= 1:
            return plain
        inside = F.coalesce(F.from_json(g["geometries"], _MEMBERS), F.array().cast(_MEMBERS))
        return F.when(F.upper(g["type"]) == "GEOMETRYCOLLECTION", _collected(inside, depth - 1)).otherwise(plain)

    texts = F.array_compact(F.transform(members, one))
    return F.when(F.size(texts) > 0, F.concat(F.lit("GEOMETRYCOLLECTION ("), F.array_join(texts, ", "), F.lit(")"))).otherwise("GEOMETRYCOLLECTION EMPTY")


def geometry_to_wkt(g: Column) -> Column:
    """A GeoJSON geometry struct (type, coordinates, geometries) -> WKT.  The
    members of a collection are kept, down to three levels; those of unknown
    type are left out."""
    members = F.coalesce(g["geometries"], F.array().cast(_MEMBERS))
    return (F.when(F.upper(g["type"]) == "GEOMETRYCOLLECTION", _collected(members, _DEPTH))
             .otherwise(coordinates_to_wkt(g["type"], g["coordinates"])))


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """FeatureCollection file(s) -> one row per feature: ``properties``
    (map of strings) and ``geom_wkt`` (NULL without a geometry).

    A file is one JSON document, yet many tasks read it: it is cut at each
    ``"Feature"``, the one value that every feature holds, so Spark splits it
    by size like any text file.  A piece holds the members of the feature
    whose type it follows, or, where writers put the type last, those of the
    feature whose type ends it; the JSON parser stops at the feature's closing
    brace.  A piece that is neither (members on both sides of the type, or the
    text ``"Feature"`` inside the properties) raises an error that names the
    piece: a feature is never lost or halved in silence."""
    pieces = spark.read.option("lineSep", _MARK).text(path).where(F.trim("value") != "")
    v = F.regexp_replace("value", "^\ufeff", "")
    # a piece opens a file ({), follows a type that comes first (,) or one that comes last (})
    opening, first, last = (F.regexp_extract(v, r"^\s*(.)", 1) == c for c in "{,}")
    type_ends = v.rlike(r'"type"\s*:\s*$')
    border = v.rlike(r'\}\s*,\s*\{[^{}\[\]]*$')
    # the head of a feature whose type ends the piece
    head = (F.when(opening, F.regexp_replace(v, r'(?s)^.*?"features"\s*:\s*\[\s*', ""))
             .when(last, F.regexp_replace(v, r"^\s*\}\s*,\s*", "")))
    bare = head.rlike(r"^\s*\{[^{}\[\]]*$")       # only scalars: its members follow
    single = opening & ~v.rlike(r'"features"\s*:\s*\[')
    headed = (opening | last) & type_ends & head.startswith("{") & ~bare & ~single
    text = F.when(first, F.concat(F.lit('{"type":"Feature"'), v)).when(headed, F.concat(head, F.lit(_MARK + "}")))
    closes = v.rlike(r'^\s*(\}\s*)?\]|"features"\s*:\s*\[\s*\]') & (opening | last)
    lone = (first | last) & v.rlike(r"^[^{}]*\}\s*$")
    f = F.from_json(text, _FEATURE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    cut = pieces.select(f.alias("f"), text.isNotNull().alias("is_feature"),
                        ((first & type_ends & ~border) | ((opening | last) & ~headed & ~(type_ends & (bare | single)) & ~closes & ~lone)).alias("odd"),
                        F.substring(v, 1, 200).alias("piece"))
    wrong = F.col("odd") | (F.col("is_feature") & (F.col("f").isNull() | F.col("f._broken").isNotNull()))
    message = F.concat(F.lit("cannot cut a GeoJSON file into features near: "), F.col("piece"))
    checked = F.when(wrong, F.raise_error(message).cast("boolean")).otherwise(F.col("is_feature"))
    return cut.where(checked).select(F.col("f.properties").alias("properties"), geometry_to_wkt(F.col("f.geometry")).alias("geom_wkt"))


def property_of(props: str, candidates, dtype: str = "string") -> Column:
    """S7 at value level: first non-null among alternative property names."""
    return F.coalesce(*[F.col(props)[c] for c in candidates]).try_cast(dtype)


def write_geojson(df: DataFrame, path: str, geom_col: str, mode: str = "overwrite") -> None:
    """One FeatureCollection a partition: points, lines, polygons and their
    multiples with all other columns as properties, written as text in the
    form that :func:`read_geojson` cuts.  A feature without vertices has a
    null geometry; a partition without rows gives no file."""
    g = F.col(geom_col)
    pair = lambda q: F.array(q["x"], q["y"])
    rings = F.transform(g["parts"], lambda p: F.transform(p, lambda r: F.transform(r, pair)))
    kind = g["gtype"]
    of = lambda k, c: F.when(kind == k, F.to_json(c))
    coordinates = F.coalesce(of("POINT", F.get(F.get(F.get(rings, F.lit(0)), F.lit(0)), F.lit(0))), of("LINESTRING", F.get(F.get(rings, F.lit(0)), F.lit(0))),
                             of("POLYGON", F.get(rings, F.lit(0))), of("MULTILINESTRING", F.transform(rings, lambda p: F.get(p, F.lit(0)))),
                             of("MULTIPOLYGON", rings))
    names = F.element_at(F.create_map(*[F.lit(x) for x in (
        "POINT", "Point", "LINESTRING", "LineString", "POLYGON", "Polygon", "MULTILINESTRING", "MultiLineString", "MULTIPOLYGON", "MultiPolygon")]), kind)
    some = F.size(F.flatten(F.flatten(g["parts"]))) > 0
    geometry = F.when(some & coordinates.isNotNull(), F.concat(F.lit('{"type":"'), names, F.lit('","coordinates":'), coordinates, F.lit("}"))).otherwise("null")
    properties = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != geom_col]), {"ignoreNullFields": "false"})
    line = F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), geometry, F.lit("}"))

    def collections(batches):
        import pyarrow as pa
        started = False
        for b in batches:
            out = [("," if started or i else '{"type":"FeatureCollection","features":[') + t for i, t in enumerate(b.column(0).to_pylist())]
            started = started or bool(out)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
        if started:
            yield pa.RecordBatch.from_arrays([pa.array(["]}"], pa.string())], ["value"])

    df.select(line.alias("value")).mapInArrow(collections, "value string").write.mode(mode).text(path)


def export_layer(df: DataFrame, path: str, geom_col: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """A map layer with the geometry as WKT text (columns lower-cased)."""
    out = df.withColumn("geometry_wkt", geo.as_wkt(geom_col)).drop(geom_col)
    out = out.select(*[F.col(f"`{c}`").alias(c.lower()) for c in out.columns])
    out.write.mode(mode).format(fmt).save(path)
