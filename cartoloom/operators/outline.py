"""Rings around covered cells, and polygons rebuilt from them under a fill rule, united or not.

Cells are shuffled once, as runs along their rows, and the rings of a group are traced where its runs meet (``traces``), many
groups together. Only groups of more than ``MOST`` runs are spread over tasks: there a covered cell gives four directed
sides with itself on their right; sides that two cells share cancel. Each side left knows the next one by its end, and
sides are numbered along their ring by pointer jumping, so rings of any length take as many rounds as the logarithm of
the longest.

Joins are merges by hint: sides come from arrays, whose lengths no estimate of a size knows, and a broadcast of them went
through the driver.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from ..functions import geom as g
from ..functions import skew
from . import burn, chains, traces

#: Groups of more runs of cells are not traced in one task.
MOST = 65_536

# Directions in a frame with y down, in the order in which they go round a cell.
RIGHT, DOWN, LEFT, UP = range(4)


def _same(left, right, pairs):
    on = F.lit(True)
    for a, b in pairs:
        on = on & F.col(f"{left}.{a}").eqNullSafe(F.col(f"{right}.{b}"))
    return on


def _sides(cells, keep):
    """Directed sides between covered and open cells: start ``sx``, ``sy``, direction ``d``, end ``ex``, ``ey``."""
    x, y = F.col("x").cast("bigint"), F.col("y").cast("bigint")
    side = lambda flat, sx, sy, n: F.struct(F.lit(flat).alias("flat"), sx.alias("x"), sy.alias("y"), F.lit(n).alias("n"))
    four = F.array(side(True, x, y, 1), side(True, x, y + 1, -1), side(False, x + 1, y, 1), side(False, x, y, -1))
    sums = cells.select(*keep, F.explode(four).alias("s")).select(*keep, "s.*").groupBy(*keep, "flat", "x", "y").agg(F.sum("n").alias("n")).where("n <> 0")
    ahead = F.col("n") > 0
    d = F.when(F.col("flat"), F.when(ahead, RIGHT).otherwise(LEFT)).otherwise(F.when(ahead, DOWN).otherwise(UP))
    back = F.when(ahead, 0).otherwise(1)
    along, across = F.when(F.col("flat"), 1).otherwise(0), F.when(F.col("flat"), 0).otherwise(1)
    sx, sy, ex, ey = (F.col(c) + k for c, k in (("x", along * back), ("y", across * back), ("x", along * (1 - back)), ("y", across * (1 - back))))
    return sums.select(*keep, sx.alias("sx"), sy.alias("sy"), d.alias("d"), ex.alias("ex"), ey.alias("ey"))


def _number(x, y, d):
    return F.shiftleft(F.col(y), 32) + F.shiftleft(F.col(x), 2) + F.col(d)


def _linked(sides, keep):
    """Every side with the next one of its ring.

    At a corner where two cells touch, a ring stays with its cell, so cells that touch in corners only are apart.
    """
    held = F.struct("sx", "sy", "d", "ex", "ey")
    none = F.lit(None).cast("struct<sx:bigint,sy:bigint,d:int,ex:bigint,ey:bigint>")
    ends = sides.select(*keep, F.explode(F.array(
        F.struct(F.col("ex").alias("vx"), F.col("ey").alias("vy"), held.alias("come"), none.alias("go")),
        F.struct(F.col("sx").alias("vx"), F.col("sy").alias("vy"), none.alias("come"), held.alias("go")),
    )).alias("e")).select(*keep, "e.*")
    corners = ends.groupBy(*keep, "vx", "vy").agg(F.collect_list("come").alias("come"), F.collect_list("go").alias("go"))  # one or two each
    turn = lambda come, go: F.pmod(go["d"] - come["d"] + 3, F.lit(4))  # noqa: E731  0 is round the same cell, 1 straight on, 2 the other way
    pick = lambda come: F.array_min(F.transform("go", lambda go: F.struct(turn(come, go).alias("turn"), go.alias("go"))))["go"]
    return corners.select(*keep, F.explode(F.transform("come", lambda c: F.struct(c.alias("c"), pick(c).alias("n")))).alias("e")).select(
        *keep, "e.c.*", F.col("e.n.sx").alias("nx"), F.col("e.n.sy").alias("ny"), F.col("e.n.d").alias("nd"),
    ).select(*keep, "sx", "sy", "d", "ex", "ey", _number("sx", "sy", "d").alias("id"), _number("nx", "ny", "nd").alias("next"))


def _ranked(linked, keep):
    """The ring of every side (its smallest number) and the steps from the side to that one.

    After ``k`` rounds a side knows the smallest of the ``2**k`` sides that begin with it. When a round changes none, each
    knows its whole ring.
    """
    state = skew.checkpoint(linked.select(*keep, "id", "next", F.col("id").alias("ring"), F.lit(0).cast("bigint").alias("steps")))
    reach = 1
    while True:
        lower = F.col("b.ring") < F.col("a.ring")
        state = skew.checkpoint(state.alias("a").join(state.alias("b").hint("merge"), _same("a", "b", [*((k, k) for k in keep), ("next", "id")])).select(
            *[f"a.{k}" for k in keep], "a.id", "b.next", F.least("a.ring", "b.ring").alias("ring"),
            F.when(lower, F.col("b.steps") + reach).otherwise(F.col("a.steps")).alias("steps"), lower.alias("changed"),
        ))
        if state.where("changed").isEmpty():
            return state.drop("changed", "next")
        state, reach = state.drop("changed"), reach * 2


def _owners(placed, rings, keep):
    """The shell of every hole: the ring that begins the run of covered cells to the left of the hole's leftmost side.

    That ring may be a hole itself, which begins further left; such chains are halved in each round.
    """
    row = Window.partitionBy(*keep, "row").orderBy("sx")
    upright = placed.where(F.col("d").isin(DOWN, UP)).withColumn("row", F.least("sy", "ey")).withColumn("before", F.lag("ring").over(row))
    left = upright.where(F.col("d") == DOWN).groupBy(*keep, "ring").agg(F.min(F.struct("sx", "sy", "before")).alias("at"))
    holes = skew.checkpoint(left.join(rings.where("area < 0").select(*[F.col(k).alias(f"_{k}") for k in keep], F.col("ring").alias("_ring")).hint("merge"),
                                      _and([F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keep] + [F.col("ring") == F.col("_ring")]), "left_semi")
                            .select(*keep, "ring", F.col("at.before").alias("shell")))
    while True:
        on = _same("a", "b", [*((k, k) for k in keep), ("shell", "ring")])
        stepped = skew.checkpoint(holes.alias("a").join(holes.alias("b").hint("merge"), on, "left").select(
            *[f"a.{k}" for k in keep], "a.ring", F.coalesce("b.shell", "a.shell").alias("shell"), F.col("b.shell").isNotNull().alias("moved")))
        if stepped.where("moved").isEmpty():
            return holes
        holes = stepped.drop("moved")


def _and(conditions):
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def _spread_rings(cells, keep, name):
    """``cover_rings`` of groups of any size, by joins of their sides."""
    linked = skew.checkpoint(_linked(_sides(cells.select(*keep, "x", "y").distinct(), keep), keep))
    ranks = _ranked(linked, keep)
    placed = linked.alias("a").join(ranks.alias("b").hint("merge"), _same("a", "b", [*((k, k) for k in keep), ("id", "id")])).select(
        *[f"a.{k}" for k in keep], "a.sx", "a.sy", "a.d", "a.ex", "a.ey", "b.ring", "b.steps")
    placed = skew.checkpoint(placed)
    rings = placed.groupBy(*keep, "ring").agg(
        F.sum(F.col("sx") * F.col("ey") - F.col("ex") * F.col("sy")).alias("area"),
        F.array_sort(F.collect_list(F.struct((F.col("steps") != 0).alias("rest"), (-F.col("steps")).alias("at"), "sx", "sy", "d"))).alias("s"),
    )

    def closed(own):
        bent = F.filter(own, lambda v, i: v["d"] != F.get(own, F.when(i == 0, F.size(own) - 1).otherwise(i - 1))["d"])
        return g.let(F.transform(bent, lambda v: g.vertex(v["sx"], v["sy"])), lambda r: F.concat(r, F.slice(r, 1, 1)))

    rings = skew.checkpoint(rings.select(*keep, "ring", "area", g.let("s", closed).alias("vs")))
    owners = _owners(placed, rings, keep)
    held = rings.alias("a").join(owners.alias("b").hint("merge"), _same("a", "b", [*((k, k) for k in keep), ("ring", "ring")]), "left").select(
        *[f"a.{k}" for k in keep], F.coalesce("b.shell", "a.ring").alias("shell"), (F.col("a.area") < 0).alias("hole"), "a.ring", "a.vs")
    parts = held.groupBy(*keep, "shell").agg(F.transform(F.array_sort(F.collect_list(F.struct("hole", "ring", "vs"))), lambda r: r["vs"]).alias("rings"))
    whole = parts.groupBy(*keep).agg(F.transform(F.array_sort(F.collect_list(F.struct("shell", "rings"))), lambda p: p["rings"]).alias("parts"))
    return whole.select(*keep, g.geometry(g.MULTIPOLYGON, F.col("parts")).alias(name))


def cover_rings(cells, keep=("fid",), name="_cells"):
    """One multipolygon per ``keep`` around its covered cells ``(x, y)``, both at least 0 and below ``2**28``.

    Shells are positive and holes negative in a frame with y down; a vertex is a corner and a ring begins with its upper
    left one. A cell may occur repeatedly; no cells give no rows.
    """
    keep = list(keep)
    cells = cells.select(*keep, F.col("x").cast("bigint").alias("x"), F.col("y").cast("bigint").alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    chains.bound_batches(cells.sparkSession)
    own = [StructField(f.name, f.dataType) for f in cells.select(*keep).schema]
    runs = StructType([*own, StructField("_runs", ArrayType(IntegerType())), StructField("_n", IntegerType())])
    # as one struct, keys with nulls are equal and a join and an aggregate share their shuffle
    held = skew.stored(cells.mapInArrow(traces.in_runs(keep), runs), "runs").select(F.struct(*keep).alias("_key"), "_runs", "_n")
    large = skew.checkpoint(held.groupBy("_key").agg(F.sum("_n").alias("_n")).where(F.col("_n") > MOST).select("_key"))
    small = held.join(large.hint("merge"), "_key", "left_anti").groupBy("_key").agg(F.flatten(F.collect_list("_runs")).alias("_runs"))
    shape = StructType([*own, StructField(name, StructType.fromDDL(f"c {g.GEOM_TYPE}")[0].dataType)])
    drawn = small.select(*[F.col("_key")[k].alias(k) for k in keep], "_runs").mapInArrow(traces.in_rings(keep, name), shape)
    if large.isEmpty():
        return drawn
    spread = held.join(large.hint("merge"), "_key", "left_semi")
    each = F.explode(F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda i: F.struct(*[F.get("_runs", 3 * i + k).cast("bigint").alias(c) for k, c in enumerate(("y", "a", "b"))])))
    spread = spread.select("_key", each.alias("_r")).select(*[F.col("_key")[k].alias(k) for k in keep], F.explode(F.sequence("_r.a", F.col("_r.b") - 1)).alias("x"), F.col("_r.y").alias("y"))
    return drawn.unionByName(_spread_rings(spread, keep, name))


def refill_polygons(df, size, buffer, rule="evenOdd", union=False, cells=256, geom="tgeom"):
    """Polygons in tile coordinates redrawn around the cells that they cover under a fill rule.

    A tile has ``cells`` x ``cells`` cells; a polygon covers those whose centre it holds, in the buffered tile. ``union``
    merges the parts of a multipolygon, otherwise each is redrawn by itself. Polygons that cover no cell go; other kinds
    of geometry stay as they are.
    """
    if size % cells:
        raise ValueError("the tile size must be a multiple of the number of cells")
    unit = size // cells
    margin = -(-buffer // unit)  # whole cells
    polygon = F.col(geom)["type"].isin(g.POLYGON, g.MULTIPOLYGON)
    shapes = skew.checkpoint(df.where(polygon).withColumn("_row", F.monotonically_increasing_id()))
    placed = shapes.select("_row", g.map_vertices(geom, lambda x, y: (x / unit + margin, y / unit + margin)).alias("_cells"))
    side = cells + 2 * margin
    keys = ["_row"] if union else ["_row", "part"]
    covered = burn.polygon_cells(placed, side, side, ["_row"], rule, not union)
    redrawn = cover_rings(covered, keys, "_new").withColumn("_new", g.map_vertices("_new", lambda x, y: ((x - margin) * unit, (y - margin) * unit)))
    if not union:
        redrawn = redrawn.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("part", F.col("_new.parts").alias("parts")))).alias("_p")).select(
            "_row", g.geometry(g.MULTIPOLYGON, F.flatten(F.transform("_p", lambda p: p["parts"]))).alias("_new"))
    out = shapes.join(redrawn.hint("merge"), "_row").withColumn(geom, g.geometry(F.when(F.size("_new.parts") == 1, g.POLYGON).otherwise(g.MULTIPOLYGON), F.col("_new.parts")))
    return df.where(~polygon).unionByName(out.select(*df.columns))
