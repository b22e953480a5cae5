"""Text forms of geometry: WKT and GeoJSON columns."""

from pyspark.sql import functions as F

from ..functions import geom as g
from ..functions import mercator as m
from .features import attribute_names


def _vertex_list(ring, sep, digits, wrap):
    """Text of a vertex array, e.g. ``1 2,3 4`` or ``[1,2],[3,4]``."""
    def one(v):
        pair = F.concat(g.number_text(v["x"], digits), F.lit(sep), g.number_text(v["y"], digits))
        return F.concat(F.lit("["), pair, F.lit("]")) if wrap else pair

    return F.array_join(F.transform(ring, one), ",")


def _nested(parts, sep, digits, wrap, opening, closing):
    def ring_text(r):
        return F.concat(F.lit(opening), _vertex_list(r, sep, digits, wrap), F.lit(closing))

    points = F.array_join(F.transform(F.flatten(parts), lambda r: _vertex_list(r, sep, digits, wrap)), ",")
    lines = F.array_join(F.transform(F.flatten(parts), ring_text), ",")
    polys = F.array_join(
        F.transform(parts, lambda p: F.concat(F.lit(opening), F.array_join(F.transform(p, ring_text), ","), F.lit(closing))), ","
    )
    return points, lines, polys


def _simple_wkt(type_, parts, digits):
    points, lines, polys = _nested(parts, " ", digits, False, "(", ")")
    body = lambda name, text: F.concat(F.lit(name + "("), text, F.lit(")"))
    return (
        F.when(type_ == g.POINT, body("POINT", points))
        .when(type_ == g.LINE, F.concat(F.lit("LINESTRING"), lines))
        .when(type_ == g.POLYGON, F.concat(F.lit("POLYGON"), polys))
        .when(type_ == g.MULTIPOINT, body("MULTIPOINT", points))
        .when(type_ == g.MULTILINE, body("MULTILINESTRING", lines))
        .when(type_ == g.MULTIPOLYGON, body("MULTIPOLYGON", polys))
    )


def wkt(geom, members=None, digits=12):
    """WKT text; a collection takes its geometries from the ``members`` array of structs."""
    geom = g.col(geom)
    text = _simple_wkt(geom["type"], geom["parts"], digits)
    if members is None:
        return text
    inner = F.array_join(F.transform(g.col(members), lambda s: _simple_wkt(s["type"], s["parts"], digits)), ",")
    return F.when(geom["type"] == g.COLLECTION, F.concat(F.lit("GEOMETRYCOLLECTION("), inner, F.lit(")"))).otherwise(text)


def to_wkt_table(df, digits=12):
    return df.select("fid", wkt("geom", "members" if "members" in df.columns else None, digits).alias("wkt"))


def _simple_geojson(type_, parts, digits):
    points, lines, polys = _nested(parts, ",", digits, True, "[", "]")
    brackets = lambda t: F.concat(F.lit("["), t, F.lit("]"))
    coords = (
        F.when(type_.isin(g.POINT, g.LINE, g.POLYGON), F.when(type_ == g.POINT, points).when(type_ == g.LINE, lines).otherwise(polys))
        .when(type_ == g.MULTIPOINT, brackets(points))
        .when(type_ == g.MULTILINE, brackets(lines))
        .when(type_ == g.MULTIPOLYGON, brackets(polys))
    )
    return F.concat(F.lit('{"type":"'), g.type_name(type_), F.lit('","coordinates":'), coords, F.lit("}"))


def geojson(geom, members=None, digits=12):
    geom = g.col(geom)
    text = _simple_geojson(geom["type"], geom["parts"], digits)
    if members is None:
        return text
    inner = F.array_join(F.transform(g.col(members), lambda s: _simple_geojson(s["type"], s["parts"], digits)), ",")
    return F.when(
        geom["type"] == g.COLLECTION, F.concat(F.lit('{"type":"GeometryCollection","geometries":['), inner, F.lit("]}"))
    ).otherwise(text)


def feature_json(fid, geom, properties, digits=12, members=None):
    """One GeoJSON feature; ``properties`` is JSON text."""
    return F.concat(
        F.lit('{"type":"Feature","id":'), g.col(fid).cast("string"),
        F.lit(',"geometry":'), F.coalesce(geojson(geom, members, digits), F.lit("null")),
        F.lit(',"properties":'), properties, F.lit("}"),
    )


def properties_json(df):
    names = attribute_names(df)
    return F.to_json(F.struct(*names)) if names else F.lit("{}")


def to_geojson_table(df, transform=None, digits=12):
    """Feature text per row; ``transform`` is a ``(source, target)`` pair of projections."""
    props = properties_json(df)
    fn = m.transformer(*transform) if transform else None
    geom = F.col("geom") if fn is None else g.map_vertices("geom", fn)
    members = F.col("members") if "members" in df.columns else None
    if fn is not None and members is not None:
        members = F.transform(members, lambda s: g.map_vertices(s, fn))
    return df.select("fid", feature_json("fid", geom, props, digits, members).alias("geojson"))


GEOMETRY_SCHEMA = "struct<type:string,coordinates:string,geometries:array<string>>"
FEATURE_SCHEMA = f"type string, id bigint, geometry {GEOMETRY_SCHEMA}, properties map<string,string>"
MAX_NESTING = 8  # collections within collections that are read


def parse_geometry(kind, coords):
    """Geometry struct from a GeoJSON type name and coordinate text; null when it does not fit."""
    def arr(depth):
        t = "double"
        for _ in range(depth):
            t = f"array<{t}>"
        return F.from_json(coords, t)

    v = lambda p: g.vertex(p[0], p[1])
    ring = lambda r: F.transform(r, v)
    parts = (
        F.when(kind == "Point", F.array(F.array(F.array(v(arr(1))))))
        .when(kind == "LineString", F.array(F.array(ring(arr(2)))))
        .when(kind == "Polygon", F.array(F.transform(arr(3), ring)))
        .when(kind == "MultiPoint", F.transform(arr(2), lambda p: F.array(F.array(v(p)))))
        .when(kind == "MultiLineString", F.transform(arr(3), lambda r: F.array(ring(r))))
        .when(kind == "MultiPolygon", F.transform(arr(4), lambda poly: F.transform(poly, ring)))
    )
    tag = F.lit(None).cast("int")
    for t, name in g.TYPE_NAMES.items():
        tag = F.when(kind == name, t).otherwise(tag)
    return g.let(parts, lambda found: F.when(F.isnotnull(found), g.geometry(tag, found)))


def parse_members(texts):
    """Geometries of a collection's member texts; collections among them are spread out, level by level.

    A member that is no geometry, or that more than ``MAX_NESTING`` collections within this one hold, is null.
    """
    parsed = lambda t: F.from_json(t, GEOMETRY_SCHEMA)
    inner = lambda p, t: F.when((p["type"] == "GeometryCollection") & p["geometries"].isNotNull(), p["geometries"]).otherwise(F.array(t))
    # only what names the kind, or could in escapes, is read again on each level
    named = lambda t: F.contains(t, F.lit("GeometryCollection")) | F.contains(t, F.lit("\\u"))
    for _ in range(MAX_NESTING):
        deeper = lambda t: F.when(named(t), g.let(parsed(t), lambda p: inner(p, t))).otherwise(F.array(t))
        texts = g.let(texts, lambda ts: F.when(F.exists(ts, named), F.flatten(F.transform(ts, deeper))).otherwise(ts))
    return F.transform(texts, lambda t: g.let(parsed(t), lambda p: parse_geometry(p["type"], p["coordinates"])))


def with_geometry(df, parsed="_f.geometry"):
    """Columns ``geom`` and ``members`` from a parsed GeoJSON geometry; both null when it does not fit.

    A collection holds its geometries in ``members``, and all their parts as its own, so that its envelope is theirs.
    """
    kind = F.col(f"{parsed}.type")
    is_collection = (kind == "GeometryCollection") & F.col(f"{parsed}.geometries").isNotNull()
    df = df.withColumn("members", F.when(is_collection, parse_members(F.col(f"{parsed}.geometries"))))
    fits = is_collection & ~F.exists("members", lambda s: s.isNull())
    together = g.geometry(g.COLLECTION, F.flatten(F.transform("members", lambda s: s["parts"])))
    return df.withColumn("geom", F.when(fits, together).otherwise(parse_geometry(kind, F.col(f"{parsed}.coordinates"))))


def from_geojson_table(df, column, keep=()):
    """Feature text to rows. Bad text, or a geometry that is no feature, is an error.

    A property that is itself an object or array stays as JSON text. ``members`` holds the geometries of a collection,
    also of those within it, and is null for other kinds.
    """
    parsed = with_geometry(df.withColumn("_f", F.from_json(F.col(column), FEATURE_SCHEMA)))
    bad = F.raise_error(F.concat(F.lit("Failed to read GeoJSON feature: "), F.coalesce(F.col(column), F.lit("null"))))
    out = parsed.withColumn(
        "geom",
        F.when((F.col("_f.type") == "Feature") & F.isnotnull("geom"), F.col("geom")).otherwise(bad.cast(g.GEOM_TYPE)),
    )
    return g.with_bounds(out.select(*keep, F.col("_f.id").alias("fid"), F.col("_f.properties").alias("props"), "geom", "members"))
