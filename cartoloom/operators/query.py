"""Point queries and the distance / containment join (Q04-Q12).

Features carry mercator geometry, envelope columns ``minx..maxy``, ``layer`` and
``fid``; query points carry ``pid`` and a position.
"""

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geom as g
from ..functions import mercator as m
from ..functions import skew
from . import features as ft
from . import reach

MAX_LEVEL = 24


def _with_hit(df, x, y):
    hit = g.geometry_hit("geom", x, y)
    return df.withColumn("_hit", hit).withColumns({n: F.col("_hit")[n] for n in ("distance", "x_hit", "y_hit")}).drop("_hit")


def distances(df, x, y):
    """Distance and hit position of every feature; -1 without a hit."""
    return _with_hit(df, F.lit(float(x)), F.lit(float(y)))


def query_point(df, x, y, layer=None, tolerance=0.0):
    """Features hit at a map coordinate."""
    if layer is not None:
        df = ft.layer_at(df, layer)
    near = ft.extent_filter(df, (x - tolerance, y - tolerance, x + tolerance, y + tolerance))
    return distances(near, x, y).where(F.col("distance").between(0, tolerance))


def query_map_point(df, view, px, py, layer=None, tolerance=0.0):
    """The same from a pixel of a view ``(width, height, box)``."""
    w, h, (minx, miny, maxx, maxy) = view
    if not (0 <= px <= w and 0 <= py <= h):
        raise ValueError("x or y outside of map bounds")
    x = minx + px * (maxx - minx) / w
    y = maxy - py * (maxy - miny) / h
    return query_point(df, x, y, layer, tolerance)


def tile_query(df, lon, lat, tolerance=0.0, layer=None):
    """Features within a mercator distance of a longitude/latitude, nearest first.

    Hit positions come back as longitude/latitude. An unknown layer is empty.
    """
    if layer is not None:
        df = df.where(F.col("layer") == layer)
    x, y = m.mercator_position(lon, lat)
    found = distances(ft.extent_filter(df, (x - tolerance, y - tolerance, x + tolerance, y + tolerance)), x, y)
    found = found.where(F.col("distance").between(0, tolerance))
    lon_hit, lat_hit = m.lon_of("x_hit"), m.lat_of("y_hit")
    return found.withColumns({"x_hit": lon_hit, "y_hit": lat_hit}).orderBy("distance", "layer", "fid")


def query_prefilter_box(points, tolerance, lon="lon", lat="lat"):
    """Mercator box of all query points, padded by the tolerance."""
    x, y = m.merc_x(lon), m.merc_y(lat)
    return points.agg(
        (F.min(x) - tolerance).alias("minx"), (F.min(y) - tolerance).alias("miny"),
        (F.max(x) + tolerance).alias("maxx"), (F.max(y) + tolerance).alias("maxy"),
    )


#: Query points are told apart in cells of the world of 2 to the power of this a side, so 16,384 rows at most reach the driver.
PREFILTER_LEVEL = 7
#: So many boxes at most go into the filter of a feature scan.
PREFILTER_BOXES = 8


def occupied_cells(points, lon="lon", lat="lat", level=PREFILTER_LEVEL):
    """Cells of the world with query points, and the box of the points in each."""
    n = 1 << level
    at = points.select(m.merc_x(lon).alias("_px"), m.merc_y(lat).alias("_py")).where("_px IS NOT NULL AND _py IS NOT NULL AND NOT isnan(_px) AND NOT isnan(_py)")
    inside = lambda c: F.least(F.greatest(F.floor(c * n), F.lit(0)), F.lit(n - 1))
    return at.groupBy(inside(m.world_u("_px")).alias("cx"), inside(m.world_v("_py")).alias("cy")).agg(
        F.min("_px").alias("minx"), F.min("_py").alias("miny"), F.max("_px").alias("maxx"), F.max("_py").alias("maxy"))


def prefilter_boxes(boxes, most=PREFILTER_BOXES):
    """``most`` boxes ``(minx, miny, maxx, maxy)`` at most that hold all given ones: the widest gap is cut first.

    Where that leaves more than half of the area of one box around all, the one box is all there is to gain.
    """

    def gap(group):
        """The widest stretch of an axis without a box, and the two sides of it."""
        best = (0.0, None, None)
        for axis in (0, 1):
            ordered = sorted(group, key=lambda b: b[axis])
            reach = ordered[0][axis + 2]
            for i, box in enumerate(ordered[1:], 1):
                if box[axis] - reach > best[0]:
                    best = (box[axis] - reach, ordered[:i], ordered[i:])
                reach = max(reach, box[axis + 2])
        return best

    open_ = [(gap(boxes), boxes)] if boxes else []
    while open_ and len(open_) < most:
        at = max(range(len(open_)), key=lambda i: open_[i][0][0])
        (wide, left, right), _ = open_[at]
        if wide <= 0:
            break
        open_[at : at + 1] = [(gap(left), left), (gap(right), right)]
    around = lambda group: tuple(f(b[i] for b in group) for i, f in enumerate((min, min, max, max)))
    area = lambda b: (b[2] - b[0]) * (b[3] - b[1])
    cut = [around(group) for _, group in open_]
    whole = around(boxes) if boxes else None
    return [whole] if boxes and 2 * sum(map(area, cut)) > area(whole) else cut


def near_points(features, points, tolerance, lon="lon", lat="lat"):
    """Features whose envelope comes within the tolerance of one of a few boxes that hold all points.

    The boxes are plain comparisons of the envelope columns, so they reach a parquet scan: with features stored in the
    order of a curve, row groups away from the points are not read. Without points nothing is known and all stay.
    """
    boxes = prefilter_boxes([(r["minx"], r["miny"], r["maxx"], r["maxy"]) for r in occupied_cells(points, lon, lat).collect()])
    if not boxes:
        return features
    touched = [
        (F.col("minx") <= x1 + tolerance) & (F.col("maxx") >= x0 - tolerance) & (F.col("miny") <= y1 + tolerance) & (F.col("maxy") >= y0 - tolerance)
        for x0, y0, x1, y1 in boxes
    ]
    return features.where(reduce(lambda a, b: a | b, touched))


#: A long segment is walked in cells of about this share of it; cells are never smaller than four tolerances.
STEPS = 16
#: Cells on each axis of a polygon's cover are 2 to the power of at most this.
DEPTH = 5
#: Room for the last bits of coordinates, in map units.
HAIR = 1e-6


def _level(span, finest=MAX_LEVEL):
    """The finest level whose cells are not smaller than ``span``."""
    world = 2 * m.HALF_WORLD
    return F.least(F.greatest(F.floor(F.log2(F.lit(world) / F.greatest(span, F.lit(world / 2**MAX_LEVEL)))), F.lit(0)), F.lit(finest)).cast("int")


def _cell_key(level, cx, cy):
    """Level and cell as one long."""
    return F.shiftleft(level.cast("long"), 56) + F.shiftleft(cx.cast("long") + 1, 28) + cy.cast("long") + 1


def _box_level(tolerance):
    """The level at which a padded envelope lies in 2 x 2 cells at most."""
    return _level(F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")) + 2 * tolerance)


def _box_cells(features, tolerance):
    """Features at the cells of their padded envelopes."""
    rows = features.withColumn("_level", _box_level(tolerance))
    n = F.pow(F.lit(2.0), F.col("_level"))
    low_x, high_x = (F.floor(m.world_u(F.col(c) + s * tolerance) * n) for c, s in (("minx", -1), ("maxx", 1)))
    low_y, high_y = (F.floor(m.world_v(F.col(c) + s * tolerance) * n) for c, s in (("maxy", 1), ("miny", -1)))
    rows = rows.withColumn("_cx", F.explode(F.sequence(low_x, high_x))).withColumn("_cy", F.explode(F.sequence(low_y, high_y)))
    return rows.withColumn("_cell", _cell_key(F.col("_level"), F.col("_cx"), F.col("_cy"))).drop("_level", "_cx", "_cy")


def _segments():
    return F.flatten(F.transform(F.flatten(F.col("geom.parts")), g.segments))


def _segment_level(s, tolerance):
    """The level of the cells that a segment is walked in."""
    reach = F.greatest(F.abs(s["b"]["x"] - s["a"]["x"]), F.abs(s["b"]["y"] - s["a"]["y"]))
    return _level(F.greatest(reach / STEPS, F.lit(4.0 * tolerance)))


def _line_cells(lines, columns, tolerance, level=None):
    """Segments at every cell that holds points within the tolerance of them, on the level that fits each or on a given one.

    A segment is walked column by column; the part of it beside a column tells the rows of cells. ``_lo`` and ``_hi``
    bound the points' y inside the column.
    """
    own = _segment_level(F.col("s"), tolerance) if level is None else F.lit(level)
    rows = lines.select(*columns, F.explode(_segments()).alias("s")).select(
        *columns, own.alias("_level"), *[F.col(f"s.{e}.{c}").alias(f"_{e}{c}") for e in "ab" for c in "xy"])
    dx, dy = F.col("_bx") - F.col("_ax"), F.col("_by") - F.col("_ay")
    pad = tolerance + HAIR
    n = F.pow(F.lit(2.0), F.col("_level"))
    low, high = (F.floor(m.world_u(f("_ax", "_bx") + s * pad) * n) for f, s in ((F.least, -1), (F.greatest, 1)))
    rows = rows.withColumn("_cx", F.explode(F.sequence(low, high)))
    width = F.lit(2 * m.HALF_WORLD) / n
    edge = F.col("_cx") * width - m.HALF_WORLD
    beside = [F.when(dx == 0, F.lit(float(k))).otherwise((x - F.col("_ax")) / F.when(dx == 0, F.lit(1.0)).otherwise(dx)) for k, x in ((0, edge - pad), (1, edge + width + pad))]
    ys = [F.col("_ay") + dy * F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0)) for t in beside]
    rows = rows.withColumns({"_lo": F.least(*ys) - pad, "_hi": F.greatest(*ys) + pad})
    rows = rows.withColumn("_cy", F.explode(F.sequence(F.floor(m.world_v("_hi") * n), F.floor(m.world_v("_lo") * n))))
    return rows.withColumn("_cell", _cell_key(F.col("_level"), F.col("_cx"), F.col("_cy"))).drop("_level", "_cx", "_cy")


def _part_edges(rings):
    """Edges of a polygon with the flag of a hole; rings of fewer than four vertices hold nothing."""
    def edges(ring, hole):
        return F.transform(g.segments(ring), lambda s: F.struct(
            s["a"]["x"].alias("ax"), s["a"]["y"].alias("ay"), s["b"]["x"].alias("bx"), s["b"]["y"].alias("by"), F.lit(hole).alias("hole")))

    holes = F.filter(F.slice(rings, 2, F.greatest(F.size(rings) - 1, F.lit(0))), lambda r: F.size(r) >= 4)
    return F.concat(edges(rings[0], 0), F.flatten(F.transform(holes, lambda r: edges(r, 1))))


def _odd(edges, hole, x, y, base):
    """Whether a ray from (x, y) towards +x crosses an odd number of edges, ``base`` of them known."""
    def crossed(e):
        rise = e["by"] - e["ay"]
        at = (e["bx"] - e["ax"]) * (y - e["ay"]) / F.when(rise == 0, F.lit(1.0)).otherwise(rise) + e["ax"]
        return (e["hole"] == hole) & ((e["ay"] > y) != (e["by"] > y)) & (x < at)

    return (F.size(F.filter(edges, crossed)) + base) % 2 == 1


def _holds(part, x, y):
    """Even-odd test with the edges that a cell keeps of a polygon."""
    return _odd(part["edges"], 0, x, y, part["shell"]) & ~_odd(part["edges"], 1, x, y, part["holes"])


def _cover_level():
    """The level of a polygon's cells: large ones and those of many vertices get finer cells."""
    whole = _level(F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")))
    by_size, by_vertices = F.lit(DEPTH + 4) - whole, F.floor(F.log2(F.size(g.vertices("geom")) + 1) / 2).cast("int")
    return F.least(whole + F.least(F.greatest(by_size, by_vertices, F.lit(1)), F.lit(DEPTH)), F.lit(MAX_LEVEL))


def _polygon_cells(polygons, columns):
    """Polygons as cells: those inside, which need no test, and those on an edge with the edges that a test there needs.

    A band of cells keeps the edges of its height. In a cell of it these are the edges that touch the cell and, of those
    to its right, the ones that end inside the band; the others cross every ray and are counted only. The state of a cell
    without an edge is that of its middle.
    """
    parts = F.transform(F.filter(F.col("geom.parts"), lambda rings: F.size(rings[0]) >= 4), _part_edges)
    rows = polygons.select(*columns, *g.BOX, parts.alias("_parts"), _cover_level().alias("_level"))
    n = F.pow(F.lit(2.0), F.col("_level"))
    size = F.lit(2 * m.HALF_WORLD) / n

    def band(cy):
        top = F.lit(m.HALF_WORLD) - cy * size
        bottom = top - size

        def near(e):
            low, high = F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"])
            return (low <= top + HAIR) & (high >= bottom - HAIR)

        def cut(e):
            """With the x range of the edge inside the band, and whether it spans the band."""
            rise = e["by"] - e["ay"]
            ends = [
                F.when(rise == 0, x).otherwise(e["ax"] + (e["bx"] - e["ax"]) * F.least(F.greatest((y - e["ay"]) / F.when(rise == 0, F.lit(1.0)).otherwise(rise), F.lit(0.0)), F.lit(1.0)))
                for x, y in ((e["ax"], top + HAIR), (e["bx"], bottom - HAIR))
            ]
            spans = (F.least(e["ay"], e["by"]) <= bottom - HAIR) & (F.greatest(e["ay"], e["by"]) >= top + HAIR)
            return F.struct(*[e[c].alias(c) for c in ("ax", "ay", "bx", "by", "hole")], (F.least(*ends) - HAIR).alias("x0"), (F.greatest(*ends) + HAIR).alias("x1"), spans.alias("spans"))

        return F.struct(cy.alias("cy"), F.transform("_parts", lambda p: F.transform(F.filter(p, near), cut)).alias("parts"))

    rows = rows.withColumn("_band", F.explode(F.transform(F.sequence(F.floor(m.world_v("maxy") * n), F.floor(m.world_v("miny") * n)), band))).drop("_parts")

    def cell(cx):
        left = cx * size - m.HALF_WORLD
        right = left + size
        middle = left + size / 2, F.lit(m.HALF_WORLD) - (F.col("_band.cy") + 0.5) * size

        def part(edges):
            touching = F.filter(edges, lambda e: (e["x1"] >= left) & (e["x0"] <= right))
            beyond = F.filter(edges, lambda e: e["x0"] > right)
            count = lambda hole: F.size(F.filter(beyond, lambda e: e["spans"] & (e["hole"] == hole)))
            kept = F.transform(F.concat(touching, F.filter(beyond, lambda e: ~e["spans"])), lambda e: F.struct(*[e[c].alias(c) for c in ("ax", "ay", "bx", "by", "hole")]))
            return F.struct((F.size(touching) > 0).alias("open"), kept.alias("edges"), count(0).alias("shell"), count(1).alias("holes"))

        return g.let(F.transform("_band.parts", part), lambda parts: F.struct(
            cx.alias("cx"), F.exists(parts, lambda p: ~p["open"] & _holds(p, *middle)).alias("inside"), F.filter(parts, lambda p: p["open"]).alias("open")))

    cells = F.transform(F.sequence(F.floor(m.world_u("minx") * n), F.floor(m.world_u("maxx") * n)), cell)
    rows = rows.withColumn("_c", F.explode(F.filter(cells, lambda c: c["inside"] | (F.size(c["open"]) > 0))))
    return rows.select(
        *columns, _cell_key(F.col("_level"), F.col("_c.cx"), F.col("_band.cy")).alias("_cell"), F.col("_c.inside").alias("_inside"),
        F.when(~F.col("_c.inside"), F.col("_c.open")).alias("_open"))


def _points_in_cells(points, levels):
    """Points in the cells of some levels."""
    n = F.pow(F.lit(2.0), F.col("_at"))
    rows = points.withColumn("_at", F.explode(F.array(*[F.lit(i) for i in levels])))
    return rows.withColumn("_cell", _cell_key(F.col("_at"), F.floor(m.world_u("_px") * n), F.floor(m.world_v("_py") * n))).drop("_at")


def _levels_in_use(features, kind, tolerance):
    """The levels of each kind of shape, 25 at most: one pass over types and envelopes.

    A line's segments are no longer than its envelope, so theirs are all levels from that of the largest envelope on.
    """
    span = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))
    coarsest = _level(F.greatest(span / STEPS, F.lit(4.0 * tolerance)))
    own = F.when(kind == 1, coarsest).when(kind == 2, _cover_level()).otherwise(_box_level(tolerance))
    levels = {}
    for r in features.select(kind.alias("kind"), own.alias("level")).where("level IS NOT NULL").distinct().collect():
        levels.setdefault(r["kind"], []).append(r["level"])
    if 1 in levels:
        finest = min(MAX_LEVEL, max(0, int(math.log2(2 * m.HALF_WORLD / max(4.0 * tolerance, 1.0)))))
        levels[1] = list(range(min(levels[1]), max(finest, *levels[1]) + 1))
    return levels


#: A task makes about so many pairs of points and features.
RANK_PAIRS = 1_000_000


def _meet(there, shapes):
    """Points and shapes of each ``_cell``. What they make grows with both, so a cell of many pairs is cut by points (``_cut``),
    a point in one cut, and the cuts are dealt to as many tasks as all pairs need."""
    met = there.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n")).join(shapes.groupBy("_cell").agg(F.count(F.lit(1)).alias("_m")), "_cell")
    met = skew.checkpoint(met.select("_cell", (F.col("_n") * F.col("_m")).alias("_pairs"), F.ceil(F.col("_n") * F.col("_m") / RANK_PAIRS).cast("int").alias("_cuts")))
    tasks = max(1, math.ceil((met.agg(F.sum("_pairs")).first()[0] or 0) / RANK_PAIRS))
    cuts = met.select("_cell", "_cuts")
    there = there.join(cuts, "_cell").withColumn("_cut", F.pmod(F.hash("pid"), F.col("_cuts"))).drop("_cuts").repartition(tasks, "_cell", "_cut")
    shapes = shapes.join(cuts, "_cell").withColumn("_cut", F.explode(F.sequence(F.lit(0), F.col("_cuts") - 1))).drop("_cuts").repartition(tasks, "_cell", "_cut")
    return there.join(shapes.hint("merge"), ["_cell", "_cut"])


def query_many(points, features, tolerance=0.0, layer=None, fields=None, deal=True):
    """For each point all features within the tolerance (a point in a polygon is at distance 0).

    Equi-joins on grid cells, in which a pair meets once. Points of features sit on the grid level that fits the tolerance;
    polygons are covered by inside cells and edge cells, lines are walked cell by cell and keep the least distance of their
    segments. Points take part on the levels in use (25 at most). Cells of points and polygons are cut by their pairs, so no
    task makes much more than ``RANK_PAIRS`` of them; adaptive execution splits hot cells of lines. Without ``deal`` the count
    of pairs is spared, for searches that make few.

    ``shape`` is a hash of the geometry: with layer and id it tells the features that were hit. Lines equal in id, vertices
    and fields are one feature.
    """
    if layer is not None:
        features = features.where(F.col("layer") == layer)
    fields = list(fields) if fields is not None else ft.attribute_names(features)
    keep = near_points(features.select("layer", "fid", *fields, "geom", *g.BOX), points, tolerance)
    pts = points.select("pid", m.merc_x("lon").alias("_px"), m.merc_y("lat").alias("_py"))
    kind = F.when(F.col("geom.type").isin(g.LINE, g.MULTILINE), 1).when(F.col("geom.type").isin(g.POLYGON, g.MULTIPOLYGON), 2).otherwise(0)
    levels = _levels_in_use(keep, kind, tolerance)
    if not levels and layer is not None and features.limit(1).isEmpty():
        raise ValueError("Could not find layer in vector tile")
    keep = keep.withColumn("shape", shape_of("geom"))
    px, py = F.col("_px"), F.col("_py")
    columns = ["layer", "fid", "shape", *fields]
    meet = _meet if deal else lambda there, shapes: there.join(shapes, "_cell")
    out = []
    if 0 in levels or not levels:
        near = meet(_points_in_cells(pts, levels.get(0, [0])), _box_cells(keep.where(kind == 0), tolerance))
        near = near.where(px.between(F.col("minx") - tolerance, F.col("maxx") + tolerance) & py.between(F.col("miny") - tolerance, F.col("maxy") + tolerance))
        away = F.when(F.col("geom.type") == g.POINT, g.distance(F.col("minx"), F.col("miny"), px, py)).otherwise(g.geometry_hit("geom", px, py)["distance"])
        out.append(near.withColumn("distance", away).where(F.col("distance").between(0, tolerance)))
    if 1 in levels:
        near = _points_in_cells(pts, levels[1]).join(_line_cells(keep.where(kind == 1), columns, tolerance), "_cell").where(py.between(F.col("_lo"), F.col("_hi")))
        away = g.segment_distance(px, py, *[F.col(c) for c in ("_ax", "_ay", "_bx", "_by")])
        hits = near.withColumn("distance", away).where(F.col("distance") <= tolerance)
        out.append(hits.groupBy("pid", *columns).agg(F.min("distance").alias("distance")))
    if 2 in levels and tolerance >= 0:
        near = meet(_points_in_cells(pts, levels[2]), _polygon_cells(keep.where(kind == 2), columns))
        out.append(near.where(F.col("_inside") | F.exists("_open", lambda p: _holds(p, px, py))).withColumn("distance", F.lit(0.0)))
    rows = [o.select("pid", "layer", "fid", "distance", *fields, "shape") for o in out]
    return reduce(DataFrame.unionByName, rows) if rows else keep.limit(0).select(F.lit(0).alias("pid"), "layer", "fid", F.lit(0.0).alias("distance"), *fields, "shape")


#: No more than about so many vertices of lines, and so many places, come together in one group.
COUNT_ROWS = 500_000
#: Groups may be smaller by this, where there are fewer of them than cores.
COUNT_TASKS = 32


def count_lines(points, lines, tolerance=0.0, layer=None):
    """For each point with a line within the tolerance, the number of ``lines`` there and the ``nearest`` distance.

    This is the count and the least distance of ``query_many`` without its hits, which grow with points times lines and
    never leave a task here. Lines and places are dealt by hash into groups of bounded size, wherever they lie, each of some
    lines and some places; only counts come back. ``pid`` tells points apart. Lines are told apart by a 64-bit hash of
    layer, id, vertices and fields; those equal in all of them are one.
    """
    if layer is not None:
        lines = lines.where(F.col("layer") == layer)
        if lines.limit(1).isEmpty():
            raise ValueError("Could not find layer in vector tile")
    fields = ft.attribute_names(lines)
    keep = near_points(lines.select("layer", "fid", *fields, "geom", *g.BOX), points, tolerance)
    keep = keep.where(F.col("geom.type").isin(g.LINE, g.MULTILINE)).withColumn("_line", F.xxhash64("layer", "fid", shape_of("geom"), *fields))
    pts = points.select("pid", m.merc_x("lon").alias("_px"), m.merc_y("lat").alias("_py")).distinct()
    places = pts.select("_px", "_py").where("_px IS NOT NULL AND _py IS NOT NULL AND NOT isnan(_px) AND NOT isnan(_py)").distinct()
    deal = lambda rows: max(1, math.ceil((rows or 0) / COUNT_ROWS))
    vertices = keep.agg(F.sum(F.size(g.vertices("geom")))).first()[0] or 0
    of_places = deal(places.count())
    of_lines = max(deal(vertices), min(keep.sparkSession.sparkContext.defaultParallelism, deal(COUNT_TASKS * vertices)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    group = ["_l", "_p"]
    ends = [F.col(f"s.{e}.{c}").alias(f"_{e}{c}") for e in "ab" for c in "xy"]
    segments = keep.select("_line", F.pmod(F.hash("_line"), F.lit(of_lines)).alias("_l"), F.explode(_segments()).alias("s")).select("_l", "_line", *ends).withColumn("_p", every(of_places))
    there = places.withColumns({"_l": every(of_lines), "_p": F.pmod(F.hash("_px", "_py"), F.lit(of_places))})
    tasks = 4 * of_lines * of_places  # so that few groups share one
    there, segments = (rows.repartition(tasks, *group) for rows in (there, segments))
    met = there.groupBy(*group).cogroup(segments.groupBy(*group)).applyInPandas(reach.in_groups(float(tolerance)), "_px double, _py double, lines long, nearest double")
    sums = met.groupBy("_px", "_py").agg(F.sum("lines").alias("lines"), F.min("nearest").alias("nearest"))
    return pts.join(sums, ["_px", "_py"]).select("pid", "lines", "nearest")


def shape_of(geom):
    """A hash of a geometry: features of one id and one hash are hit by the same points."""
    return F.xxhash64(geom)


def hits_by_point(hits, per_part=10_000):
    """Hits grouped per point, nearest first; a point with more than ``per_part`` hits has several parts."""
    return skew.sorted_arrays(hits, ["pid"], ["distance", "fid"], F.struct("distance", "fid"), "hits", per_part)


def ranked_hits(points, features, tolerance=0.0):
    """Hits of point features, each with its 0-based ``rank`` by distance and ``fid`` among those of its point.

    All of them lie on one level, so a point meets its features in its own cell and its hits are ranked where they are
    made: what is shuffled grows with points and features, not with hits. A cell of many pairs is cut by points. ``pid``
    tells points apart.
    """
    keep = near_points(features.select("fid", "geom", *g.BOX), points, tolerance).where(F.col("geom.type") == g.POINT).drop("geom")
    level = int(keep.sparkSession.range(1).select(_level(F.lit(2.0 * tolerance))).first()[0])
    there = _points_in_cells(points.select("pid", m.merc_x("lon").alias("_px"), m.merc_y("lat").alias("_py")), [level]).where("_cell IS NOT NULL")
    shapes = _box_cells(keep, tolerance).select("_cell", "fid", "minx", "miny")
    pairs = _meet(there, shapes)
    hits = pairs.withColumn("distance", g.distance(F.col("minx"), F.col("miny"), F.col("_px"), F.col("_py"))).where(F.col("distance").between(0, tolerance))
    rank = F.row_number().over(Window.partitionBy("_cell", "_cut", "pid").orderBy("distance", "fid")) - 1
    return hits.select("pid", rank.alias("rank"), "fid", "distance")


def hit_features(features, hits):
    """Features hit at least once, with a dense 0-based ``feature_id`` in scan order.

    Features that share layer and id are told apart by their geometry, if the hits have its ``shape``.
    """
    own = "shape" in hits.columns
    keys = ["layer", "fid", *(["_shape"] if own else [])]
    rows = features.withColumn("_shape", shape_of("geom")) if own else features
    found = hits.withColumnRenamed("shape", "_shape").select(*keys).distinct()
    hit = rows.join(found, keys, "left_semi").select(*features.columns)
    order = [c for c in ("layer_ord", "layer", "fid") if c in features.columns]
    return skew.dense_index(hit, order, "feature_id")


def nearest_hit(hits):
    """Closest feature per point; an aggregate, so hot points combine before the shuffle."""
    best = F.min(F.struct("distance", "layer", "fid"))
    return hits.groupBy("pid").agg(best.alias("b")).select("pid", "b.distance", "b.layer", "b.fid")


def miss_points(points, hits):
    """Points without any hit."""
    return points.join(hits.select("pid").distinct(), "pid", "left_anti")


#: A search in rounds begins with the tolerance divided by this, and multiplies it by this from one round to the next ...
GROWTH = 8
#: ... so that the last of so many rounds has the whole tolerance.
ROUNDS = 3


def growing(tolerance):
    """Tolerances of the rounds of a search; the last one is ``tolerance``."""
    return [tolerance / GROWTH**k for k in range(ROUNDS - 1, -1, -1)] if tolerance > 0 else [tolerance]


def _search(points, features, tolerance, find):
    """``find(hits)`` of each round, one row per point found at most; a point with a hit takes no part in the later rounds.

    All features within a round's tolerance are met, so what is nearest there is nearest of all. Where features are dense
    most points leave early, and where they are not a point meets few: the pairs grow with points and features, not with
    their product. Returns the found rows and the points without a hit.
    """
    found = []
    for near in growing(tolerance):
        found.append(skew.checkpoint(find(query_many(points, features, near, fields=[], deal=False))))
        gone = found[-1].select(F.col("pid").alias("_pid"))
        points = points.join(gone, F.col("pid").eqNullSafe(F.col("_pid")), "left_anti")
    return reduce(DataFrame.unionByName, found), points


def nearest_many(points, features, tolerance=0.0):
    """Closest feature per point within the tolerance: ``nearest_hit`` of all hits, without making all of them."""
    return _search(points, features, tolerance, nearest_hit)[0]


def unhit_points(points, features, tolerance=0.0):
    """Points without any feature within the tolerance: ``miss_points`` of all hits, without making all of them."""
    return _search(points, features, tolerance, lambda hits: hits.select("pid").distinct())[1]


def touched_features(points, features, tolerance=0.0):
    """``hit_features`` of all hits, without making all of them: a feature that was hit takes no part in the later rounds."""
    keys, found, left = ["layer", "fid", "shape"], [], features
    for near in growing(tolerance):
        found.append(skew.checkpoint(query_many(points, left, near, fields=[], deal=False).select(*keys).distinct()))
        hit = found[-1].withColumnRenamed("shape", "_shape")
        left = left.withColumn("_shape", shape_of("geom")).join(hit, ["layer", "fid", "_shape"], "left_anti").select(*features.columns)
    return hit_features(features, reduce(DataFrame.unionByName, found))
