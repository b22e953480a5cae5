"""Geometry as plain structs, worked on with built-in column expressions.

A geometry is ``struct<type, parts>`` where ``parts[polygon][ring][vertex]``;
a line is ``parts[i][0]`` and a point ``parts[i][0][0]``.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Geometry type tags and their GeoJSON names.
UNKNOWN, POINT, LINE, POLYGON, MULTIPOINT, MULTILINE, MULTIPOLYGON, COLLECTION = range(8)
TYPE_NAMES = {
    POINT: "Point",
    LINE: "LineString",
    POLYGON: "Polygon",
    MULTIPOINT: "MultiPoint",
    MULTILINE: "MultiLineString",
    MULTIPOLYGON: "MultiPolygon",
    COLLECTION: "GeometryCollection",
}

VERTEX_TYPE = "struct<x:double,y:double>"
PARTS_TYPE = f"array<array<array<{VERTEX_TYPE}>>>"
GEOM_TYPE = f"struct<type:int,parts:{PARTS_TYPE}>"
BOX = ("minx", "miny", "maxx", "maxy")


def col(c):
    return F.col(c) if isinstance(c, str) else c


def vertex(x, y) -> Column:
    return F.struct(col(x).cast("double").alias("x"), col(y).cast("double").alias("y"))


def geometry(type_, parts) -> Column:
    type_ = F.lit(type_) if isinstance(type_, int) else type_
    return F.struct(type_.cast("int").alias("type"), parts.alias("parts"))


def point(x, y) -> Column:
    return geometry(POINT, F.array(F.array(F.array(vertex(x, y)))))


def line(vertices) -> Column:
    return geometry(LINE, F.array(F.array(col(vertices))))


def polygon(*rings) -> Column:
    return geometry(POLYGON, F.array(F.array(*[col(r) for r in rings])))


def box_ring(minx, miny, maxx, maxy) -> Column:
    """Closed counter-clockwise ring of a box."""
    x0, y0, x1, y1 = (col(c) for c in (minx, miny, maxx, maxy))
    return F.array(vertex(x0, y0), vertex(x1, y0), vertex(x1, y1), vertex(x0, y1), vertex(x0, y0))


def vertices(geom) -> Column:
    return F.flatten(F.flatten(col(geom)["parts"]))


def map_vertices(geom, fn) -> Column:
    """Apply ``fn(x, y) -> (x, y)`` to every vertex."""
    def move(v):
        x, y = fn(v["x"], v["y"])
        return vertex(x, y)

    g = col(geom)
    return geometry(
        g["type"],
        F.transform(g["parts"], lambda part: F.transform(part, lambda ring: F.transform(ring, move))),
    )


def bounds(geom) -> dict[str, Column]:
    vs = vertices(geom)
    return {
        "minx": F.array_min(F.transform(vs, lambda v: v["x"])),
        "miny": F.array_min(F.transform(vs, lambda v: v["y"])),
        "maxx": F.array_max(F.transform(vs, lambda v: v["x"])),
        "maxy": F.array_max(F.transform(vs, lambda v: v["y"])),
    }


def with_bounds(df, geom="geom"):
    """Add the envelope as four plain columns, so that parquet statistics cover them."""
    return df.withColumns(bounds(geom))


def overlaps(box, names=BOX) -> Column:
    minx, miny, maxx, maxy = box
    return (
        (F.col(names[0]) <= maxx) & (F.col(names[2]) >= minx)
        & (F.col(names[1]) <= maxy) & (F.col(names[3]) >= miny)
    )


def let(value, fn) -> Column:
    """``fn(value)`` with the value computed once, however often ``fn`` uses it."""
    return F.transform(F.array(value), fn)[0]


def runs(items, begins, make) -> Column:
    """``make(run)`` for every run of an array; ``begins(item, before)`` tells where a run after the first one begins."""
    def cut(own):
        places = F.filter(F.sequence(F.lit(0), F.size(own) - 1), lambda i: (i == 0) | begins(F.get(own, i), F.get(own, i - 1)))
        return let(places, lambda at: F.transform(at, lambda i, k: make(F.slice(own, i + 1, F.coalesce(F.get(at, k + 1), F.size(own)) - i))))

    return let(items, lambda own: F.when(F.size(own) > 0, cut(own)).otherwise(F.transform(own, lambda x: make(F.array(x)))))  # none of none


def replace_geometry(df, value, geom="geom"):
    """Set a geometry column and drop the rows whose geometry has no parts left.

    A generator does both, so the expression runs once per row; a filter on a
    projected geometry would be pushed below it and repeat the work.
    """
    return df.withColumn(geom, F.explode(F.filter(F.array(value), lambda q: F.size(q["parts"]) > 0)))


def segments(ring) -> Column:
    """Consecutive vertex pairs of a vertex array, as ``struct<a, b>``."""
    def pairs(r):
        n = F.size(r)
        return F.when(
            n > 1,
            F.zip_with(F.slice(r, 1, F.greatest(n - 1, F.lit(0))), F.slice(r, 2, F.greatest(n - 1, F.lit(0))),
                       lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
        ).otherwise(F.expr(f"cast(array() as array<struct<a:{VERTEX_TYPE},b:{VERTEX_TYPE}>>)"))

    return let(col(ring), pairs)


def ring_area(ring) -> Column:
    """Signed area, positive when counter-clockwise in a y-up frame."""
    return F.aggregate(
        segments(ring),
        F.lit(0.0),
        lambda acc, s: acc + (s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"]),
    ) / 2


def polygon_area(rings) -> Column:
    """Area of the exterior ring minus the areas of the holes."""
    areas = F.transform(col(rings), lambda r, i: F.abs(ring_area(r)) * F.when(i == 0, 1).otherwise(-1))
    return F.aggregate(areas, F.lit(0.0), lambda acc, a: acc + a)


def distance(x0, y0, x1, y1) -> Column:
    dx, dy = x1 - x0, y1 - y0
    return F.sqrt(dx * dx + dy * dy)


def segment_distance(x, y, ax, ay, bx, by) -> Column:
    """Distance from (x, y) to the segment a-b."""
    dx, dy = bx - ax, by - ay
    length2 = dx * dx + dy * dy
    t = F.when(length2 == 0, F.lit(0.0)).otherwise(((x - ax) * dx + (y - ay) * dy) / F.when(length2 == 0, F.lit(1.0)).otherwise(length2))
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    return distance(x, y, ax + t * dx, ay + t * dy)


HIT_TYPE = "struct<distance:double,x_hit:double,y_hit:double>"
NO_HIT = (-1.0, 0.0, 0.0)


def hit(distance_, x, y) -> Column:
    return F.struct(distance_.cast("double").alias("distance"), x.alias("x_hit"), y.alias("y_hit"))


def no_hit() -> Column:
    return hit(*[F.lit(v) for v in NO_HIT])


def _first_least(hits) -> Column:
    """First hit with the least distance; distances below zero never win."""
    return F.aggregate(
        hits,
        no_hit(),
        lambda best, h: F.when(
            (h["distance"] >= 0) & ((best["distance"] < 0) | (h["distance"] < best["distance"])), h
        ).otherwise(best),
    )


def point_hit(vs, x, y) -> Column:
    """Nearest vertex of a point or multipoint."""
    return _first_least(F.transform(vs, lambda v: hit(distance(v["x"], v["y"], x, y), v["x"], v["y"])))


def line_hit(lines, x, y) -> Column:
    """Nearest segment; the hit position is the segment's first vertex. Fewer than two vertices: no hit."""
    segs = F.flatten(F.transform(lines, segments))
    return _first_least(
        F.transform(
            segs,
            lambda s: hit(
                segment_distance(x, y, s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"]),
                s["a"]["x"], s["a"]["y"],
            ),
        )
    )


def _crossings(ring, x, y) -> Column:
    """Number of ring edges that a ray from (x, y) towards +x crosses."""
    return F.size(
        F.filter(
            segments(ring),
            lambda s: ((s["a"]["y"] > y) != (s["b"]["y"] > y))
            & (
                x < (s["b"]["x"] - s["a"]["x"]) * (y - s["a"]["y"])
                / F.when(s["b"]["y"] == s["a"]["y"], F.lit(1.0)).otherwise(s["b"]["y"] - s["a"]["y"])
                + s["a"]["x"]
            ),
        )
    )


def in_polygon(rings, x, y) -> Column:
    """Even-odd test; an exterior ring below four vertices holds nothing, such a hole is ignored."""
    rings = col(rings)
    odd = lambda n: n % 2 == 1
    shell = F.get(rings, F.lit(0))
    in_shell = (F.size(shell) >= 4) & odd(_crossings(shell, x, y))
    holes = F.filter(F.slice(rings, 2, F.greatest(F.size(rings) - 1, F.lit(0))), lambda r: F.size(r) >= 4)
    in_holes = F.size(F.filter(holes, lambda r: odd(_crossings(r, x, y)))) % 2 == 1
    return F.coalesce(in_shell & ~in_holes, F.lit(False))


def polygon_hit(polys, x, y) -> Column:
    """Distance 0 inside, no hit outside; the hit position stays at the origin."""
    return F.when(F.exists(polys, lambda rings: in_polygon(rings, x, y)), hit(F.lit(0.0), F.lit(0.0), F.lit(0.0))).otherwise(no_hit())


def geometry_hit(geom, x, y) -> Column:
    """Distance from a geometry of any kind to (x, y), -1 when there is none."""
    g, x, y = col(geom), col(x), col(y)
    t = g["type"]
    return (
        F.when(t.isin(POINT, MULTIPOINT), point_hit(vertices(g), x, y))
        .when(t.isin(LINE, MULTILINE), line_hit(F.flatten(g["parts"]), x, y))
        .when(t.isin(POLYGON, MULTIPOLYGON), polygon_hit(g["parts"], x, y))
        .otherwise(no_hit())
    )


def type_name(t) -> Column:
    t = col(t)
    named = F.lit("Unknown")
    for tag, name in reversed(TYPE_NAMES.items()):
        named = F.when(t == tag, name).otherwise(named)
    return named


def tile_type(t) -> Column:
    """Tile geometry tag: 1 point, 2 line, 3 polygon, 0 unknown."""
    t = col(t)
    return (
        F.when(t.isin(POINT, MULTIPOINT), 1).when(t.isin(LINE, MULTILINE), 2)
        .when(t.isin(POLYGON, MULTIPOLYGON), 3).otherwise(0)
    )


def number_text(v, digits=12) -> Column:
    """Plain decimal text without trailing zeros."""
    text = F.round(col(v), digits).cast(f"decimal(38,{digits})").cast("string")
    return F.regexp_replace(text, r"\.0*$|(\.\d*?[1-9])0+$", "$1")
