"""Simplicity and validity reports on tile geometry."""

from pyspark.sql import functions as F

from ..functions import geom as g
from . import export, tiles as tl

# Our own wording: the reference's messages come from an outside library.
TOO_FEW = "too few points"
UNCLOSED = "ring is not closed"
SELF_CROSSING = "self-intersection"
ORIENTATION = "wrong ring orientation"

#: A geometry of so many segments is one cell; one of n has no more than n / FEW cells on an axis.
FEW = 8
#: Geometries of up to so many vertices are compared segment by segment in their own row, without a shuffle; larger ones by cells.
IN_ROW = 32


def segment_table(df, geom="tgeom", keys=("layer", "fid")):
    """One row per segment with its number inside the ring, the ring's segment count and the vertex that follows it."""
    rings = df.select(*keys, F.col(geom)["type"].alias("type"), F.posexplode(F.col(geom)["parts"]).alias("part", "_rings"))
    rings = rings.select(*keys, "type", "part", F.posexplode("_rings").alias("ring", "_vs"))
    followed = g.let(g.segments("_vs"), lambda own: F.transform(own, lambda s, i: F.struct(s["a"].alias("a"), s["b"].alias("b"), F.get(own, (i + 1) % F.size(own))["b"].alias("c"))))
    return rings.select(
        *keys, "type", "part", "ring", F.greatest(F.size("_vs") - 1, F.lit(0)).alias("n"),
        F.posexplode(followed).alias("seg", "_s"),
    ).select(
        *keys, "type", "part", "ring", "n", "seg",
        *[F.col(f"_s.{v}.{c}").alias(f"{v}{c}") for v in "abc" for c in "xy"],
    )


def _side(px, py, qx, qy, rx, ry):
    return F.signum((qx - px) * (ry - py) - (qy - py) * (rx - px))


def _meet(a, b):
    """Two segments share a point."""
    d1, d2 = _side(a["ax"], a["ay"], a["bx"], a["by"], b["ax"], b["ay"]), _side(a["ax"], a["ay"], a["bx"], a["by"], b["bx"], b["by"])
    d3, d4 = _side(b["ax"], b["ay"], b["bx"], b["by"], a["ax"], a["ay"]), _side(b["ax"], b["ay"], b["bx"], b["by"], a["bx"], a["by"])
    on = lambda s, x, y: (
        x.between(F.least(s["ax"], s["bx"]), F.greatest(s["ax"], s["bx"])) & y.between(F.least(s["ay"], s["by"]), F.greatest(s["ay"], s["by"]))
    )
    return (
        ((d1 * d2 < 0) & (d3 * d4 < 0))
        | ((d1 == 0) & on(a, b["ax"], b["ay"])) | ((d2 == 0) & on(a, b["bx"], b["by"]))
        | ((d3 == 0) & on(b, a["ax"], a["ay"])) | ((d4 == 0) & on(b, a["bx"], a["by"]))
    )


def _cross(a, b):
    """Two segments cross inside both, or share a stretch."""
    d1, d2 = _side(a["ax"], a["ay"], a["bx"], a["by"], b["ax"], b["ay"]), _side(a["ax"], a["ay"], a["bx"], a["by"], b["bx"], b["by"])
    d3, d4 = _side(b["ax"], b["ay"], b["bx"], b["by"], a["ax"], a["ay"]), _side(b["ax"], b["ay"], b["bx"], b["by"], a["bx"], a["by"])

    def overlap(p, q):
        low = F.greatest(F.least(a[p], a[q]), F.least(b[p], b[q]))
        return low < F.least(F.greatest(a[p], a[q]), F.greatest(b[p], b[q]))

    return ((d1 * d2 < 0) & (d3 * d4 < 0)) | ((d1 == 0) & (d2 == 0) & (overlap("ax", "bx") | overlap("ay", "by")))


def _through(a, b):
    """Two rings cross in a vertex: one passes from one side of the other to its other side.

    Every vertex of a closed ring ends one segment, so pairs of such ends, and an end inside the other segment, are all.
    """
    def between(px, py, qx, qy, wx, wy):
        """Whether direction w lies strictly between p and q, counter-clockwise."""
        turn, after, before = px * qy - py * qx, px * wy - py * wx, wx * qy - wy * qx
        straight = (turn == 0) & (px * qx + py * qy < 0) & (after > 0)
        return ((turn > 0) & (after > 0) & (before > 0)) | ((turn < 0) & ~((after <= 0) & (before <= 0))) & ~_ray(px, py, wx, wy) & ~_ray(qx, qy, wx, wy) | straight

    def crossing(own, p, q):
        """The corner at the end of ``own`` against the directions to p and q from there."""
        x, y = own["bx"], own["by"]
        to = lambda v: (v[0] - x, v[1] - y)
        u, v = to((own["ax"], own["ay"])), to((own["cx"], own["cy"]))
        p, q = to(p), to(q)
        return (between(*p, *q, *u) & between(*q, *p, *v)) | (between(*q, *p, *u) & between(*p, *q, *v))

    def inside(own, other):
        """The end of ``own`` lies on ``other`` and is none of its ends."""
        x, y = own["bx"], own["by"]
        level = _side(other["ax"], other["ay"], other["bx"], other["by"], x, y) == 0
        held = x.between(F.least(other["ax"], other["bx"]), F.greatest(other["ax"], other["bx"])) & y.between(F.least(other["ay"], other["by"]), F.greatest(other["ay"], other["by"]))
        return level & held & ((x != other["ax"]) | (y != other["ay"])) & ((x != other["bx"]) | (y != other["by"]))

    at = lambda s, v: (s[f"{v}x"], s[f"{v}y"])
    both = (a["bx"] == b["bx"]) & (a["by"] == b["by"])
    return (
        (both & crossing(a, at(b, "a"), at(b, "c")))
        | (inside(a, b) & crossing(a, at(b, "a"), at(b, "b")))
        | (inside(b, a) & crossing(b, at(a, "a"), at(a, "b")))
    )


def _ray(px, py, wx, wy):
    """Two directions are one."""
    return (px * wy - py * wx == 0) & (px * wx + py * wy > 0)


def segment_cells(segments, keys=("layer", "fid")):
    """Segments at the cells that they pass, walked column by column.

    Cells are at least as wide and as high as the geometry's segments are on average, so a segment passes three of them on
    average at most, however long or steep its neighbours are. ``_low.._high`` are the cells of a column, ``_low0.._high0`` those
    of the column before it, null in the first one.
    """
    keys = list(keys)
    lo = lambda a, b: F.least(F.col(a), F.col(b))
    hi = lambda a, b: F.greatest(F.col(a), F.col(b))
    spans = {"x": F.sum(F.abs(F.col("ax") - F.col("bx"))), "y": F.sum(F.abs(F.col("ay") - F.col("by")))}
    frame = segments.groupBy(*keys).agg(
        *[F.min(lo(f"a{c}", f"b{c}")).alias(f"_{c}0") for c in "xy"], *[F.max(hi(f"a{c}", f"b{c}")).alias(f"_{c}1") for c in "xy"],
        *[(total / F.count(F.lit(1))).alias(f"_w{c}") for c, total in spans.items()], F.count(F.lit(1)).alias("_n"),
    )
    # a handful of segments share one cell
    frame = frame.withColumns({f"_w{c}": F.greatest(f"_w{c}", (F.col(f"_{c}1") - F.col(f"_{c}0")) * 1.000001 * FEW / F.col("_n")) for c in "xy"}).drop("_n")
    rows = segments.join(frame, keys)
    width = {c: F.when(F.col(f"_w{c}") > 0, F.col(f"_w{c}")).otherwise(F.lit(1.0)) for c in "xy"}
    at = lambda c, v: F.floor((v - F.col(f"_{c}0")) / width[c])
    rows = rows.withColumn("_first", at("x", lo("ax", "bx"))).withColumn("_cx", F.explode(F.sequence(F.col("_first"), at("x", hi("ax", "bx")))))
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")

    def range_in(column):
        left = F.col("_x0") + column * width["x"]
        hair = (F.abs(F.col("_x0")) + F.abs(F.col("_x1")) + 1) * 1e-12  # room for the last bits
        t = [F.least(F.greatest((x - F.col("ax")) / F.when(dx == 0, F.lit(1.0)).otherwise(dx), F.lit(0.0)), F.lit(1.0)) for x in (left - hair, left + width["x"] + hair)]
        ends = [F.when(dx == 0, y).otherwise(F.col("ay") + dy * k) for y, k in ((F.col("ay"), t[0]), (F.col("by"), t[1]))]
        room = (F.abs(F.col("_y0")) + F.abs(F.col("_y1")) + 1) * 1e-12
        return at("y", F.least(*ends) - room), at("y", F.greatest(*ends) + room)

    low, high = range_in(F.col("_cx"))
    low0, high0 = range_in(F.col("_cx") - 1)
    before = F.col("_cx") > F.col("_first")
    rows = rows.withColumns({"_low": low, "_high": high, "_low0": F.when(before, low0), "_high0": F.when(before, high0)})
    return rows.withColumn("_cy", F.explode(F.sequence("_low", "_high")))


def _bad(a, b):
    """Two segments of one geometry, ``a`` before ``b``, meet other than as neighbours."""
    same_ring = (a["part"] == b["part"]) & (a["ring"] == b["ring"])
    closed_ends = (a["seg"] == 0) & (b["seg"] == b["n"] - 1) & (a["ax"] == b["bx"]) & (a["ay"] == b["by"])
    neighbours = same_ring & ((b["seg"] == a["seg"] + 1) | closed_ends)
    # neighbours share one end; they cross only when they fold back on each other
    shared_next = (b["seg"] == a["seg"] + 1)
    fold_next = (_side(a["ax"], a["ay"], a["bx"], a["by"], b["bx"], b["by"]) == 0) & (
        ((a["ax"] - a["bx"]) * (b["bx"] - a["bx"]) + (a["ay"] - a["by"]) * (b["by"] - a["by"])) > 0)
    fold_ends = (_side(b["ax"], b["ay"], b["bx"], b["by"], a["bx"], a["by"]) == 0) & (
        ((b["ax"] - a["ax"]) * (a["bx"] - a["ax"]) + (b["ay"] - a["ay"]) * (a["by"] - a["ay"])) > 0)
    return F.when(neighbours, F.when(shared_next, fold_next).otherwise(fold_ends)).when(
        a["type"].isin(g.POLYGON, g.MULTIPOLYGON) & ~same_ring, _cross(a, b) | _through(a, b)).otherwise(_meet(a, b))


def crosses_itself(geom):
    """Whether two segments of a geometry meet other than as neighbours: every pair of them, in the row."""
    geom = g.col(geom)

    def ring(vs, part, at):
        return g.let(g.segments(vs), lambda own: F.transform(own, lambda s, i: F.struct(
            geom["type"].alias("type"), part.alias("part"), at.alias("ring"), F.size(own).alias("n"), i.alias("seg"),
            *[s[v][c].alias(f"{v}{c}") for v in "ab" for c in "xy"], *[F.get(own, (i + 1) % F.size(own))["b"][c].alias(f"c{c}") for c in "xy"])))

    def beside(a, b):
        """The boxes of two segments have a point in common."""
        lo, hi = (lambda s, c, f=f: f(s[f"a{c}"], s[f"b{c}"]) for f in (F.least, F.greatest))
        return (lo(a, "x") <= hi(b, "x")) & (lo(b, "x") <= hi(a, "x")) & (lo(a, "y") <= hi(b, "y")) & (lo(b, "y") <= hi(a, "y"))

    def any_pair(own):
        later = lambda i: F.slice(own, i + 2, F.size(own))
        met = lambda a, rest: F.exists(rest, lambda b: beside(a, b) & _bad(a, b))
        first = lambda i: F.exists(F.slice(own, i + 1, 1), lambda a: met(a, later(i)))
        return F.when(F.size(own) > 1, F.exists(F.sequence(F.lit(0), F.size(own) - 2), first)).otherwise(F.lit(False))

    segments = F.flatten(F.transform(geom["parts"], lambda rings, p: F.flatten(F.transform(rings, lambda vs, r: ring(vs, p, r)))))
    return F.coalesce(g.let(segments, any_pair), F.lit(False))


def crossing_pairs(segments, keys=("layer", "fid")):
    """Segment pairs of one geometry that meet other than as neighbours.

    Different rings of a polygon may touch in a point: of them only pairs count that cross inside both segments, share a
    stretch, or cross in a vertex.

    Only segments of one cell are compared, and a pair in the first cell that both pass. Adaptive execution splits cells
    that still hold a large share of the rows.
    """
    keys = list(keys)
    rows = segment_cells(segments, keys)
    rows = rows.withColumn("s", F.struct("part", "ring", "n", "seg", "type", "ax", "ay", "bx", "by", "cx", "cy", "_low", "_low0", "_high0")).select(*keys, "_cx", "_cy", "s")
    left, right = rows.withColumnRenamed("s", "a"), rows.withColumnRenamed("s", "b")
    earlier = F.coalesce((F.col("a._low0") <= F.col("b._high0")) & (F.col("b._low0") <= F.col("a._high0")), F.lit(False))
    pairs = left.join(right, [*keys, "_cx", "_cy"]).where((F.col("_cy") == F.greatest("a._low", "b._low")) & ~earlier)
    a, b = F.col("a"), F.col("b")
    order = F.struct(a["part"], a["ring"], a["seg"]) < F.struct(b["part"], b["ring"], b["seg"])
    return pairs.where(order & _bad(a, b))


def simplicity_report(df, geom="tgeom", keys=("layer", "fid")):
    """Keys of geometries that are not simple: repeated points in a multipoint, crossings in lines and rings."""
    keys = list(keys)
    vs, kind = g.vertices(geom), F.col(geom)["type"]
    repeated = (kind == g.MULTIPOINT) & (F.size(F.array_distinct(vs)) < F.size(vs))
    lines, small = ~kind.isin(g.POINT, g.MULTIPOINT), F.size(vs) <= IN_ROW
    settled = df.where(F.when(lines, F.when(small, crosses_itself(geom))).otherwise(repeated)).select(*keys)
    pairs = crossing_pairs(segment_table(df.where(lines & ~small), geom, keys), keys)
    return settled.unionByName(pairs.select(*keys)).distinct()


def validity_report(df, geom="tgeom", keys=("layer", "fid"), split_multi=False, lat_lon=False, web_merc=False, size=tl.SIZE, digits=6):
    """Rows ``(keys, message, geojson)`` of invalid geometries.

    With ``split_multi`` each part is checked and reported by itself. The text
    is in tile coordinates, or in longitude/latitude or mercator when asked.
    """
    if lat_lon and web_merc:
        raise ValueError("choose one of lat_lon and web_merc")
    srs = 4326 if lat_lon else 3857 if web_merc else None
    return validity_texts(df, {"geojson": srs}, geom, keys, split_multi, size, digits)


def validity_texts(df, texts, geom="tgeom", keys=("layer", "fid"), split_multi=False, size=tl.SIZE, digits=6):
    """``validity_report`` with a text column per entry of ``texts`` (name: 4326, 3857 or None for tile coordinates), all from one search."""
    keys, outs = list(keys), [f"_{name}" for name in texts]
    src = df
    for out, srs in zip(outs, texts.values()):
        src = tl.dequantize(src, size, srs, out) if srs else src.withColumn(out, F.col(geom))
    if split_multi:
        pieces = F.arrays_zip(F.col(geom)["parts"].alias("c"), *[F.col(o)["parts"].alias(o) for o in outs])
        single = F.when(F.col("_t") > 3, F.col("_t") - 3).otherwise(F.col("_t"))
        src = src.withColumn("_t", F.col(geom)["type"]).select(*keys, "_t", F.posexplode(pieces).alias("piece", "_p")).select(
            *keys, "piece", g.geometry(single, F.array(F.col("_p")["c"])).alias(geom), *[g.geometry(single, F.array(F.col("_p")[o])).alias(o) for o in outs],
        )
    else:
        src = src.select(*keys, F.lit(0).alias("piece"), geom, *outs)
    ids = [*keys, "piece"]
    c = F.col(geom)
    areal = c["type"].isin(g.POLYGON, g.MULTIPOLYGON)
    rings, small = F.flatten(c["parts"]), F.size(g.vertices(geom)) <= IN_ROW
    few = F.when(areal, F.exists(rings, lambda r: F.size(r) < 4)).when(
        c["type"].isin(g.LINE, g.MULTILINE), F.exists(rings, lambda r: F.size(F.array_distinct(r)) < 2)).otherwise(F.lit(False))
    open_ring = areal & F.exists(rings, lambda r: F.get(r, F.lit(0)) != F.try_element_at(r, F.lit(-1)))
    turned = areal & F.exists(c["parts"], lambda p: F.exists(F.transform(p, lambda r, i: (g.ring_area(r) != 0) & ((g.ring_area(r) > 0) != (i == 0))), lambda b: b))
    simple_rules = src.withColumn("message", F.explode(F.array_compact(F.array(
        F.when(few, TOO_FEW), F.when(open_ring, UNCLOSED), F.when(turned, ORIENTATION), F.when(areal & small & crosses_itself(geom), SELF_CROSSING),
    ))))
    large = src.where(areal & ~small)
    crossing = crossing_pairs(segment_table(large, geom, ids), ids).select(*ids).distinct()
    crossed = large.join(crossing, ids).withColumn("message", F.lit(SELF_CROSSING))
    out = simple_rules.select(*ids, "message", *outs).unionByName(crossed.select(*ids, "message", *outs))
    return out.select(*ids, "message", *[export.geojson(o, None, digits).alias(name) for o, name in zip(outs, texts)])
