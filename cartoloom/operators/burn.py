"""Which grid cells a geometry covers: points, lines and polygons in cell coordinates.

Work per feature grows with its edges and the rows they cross, plus the cells
that come out; no cell is ever compared with an edge.
"""

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..functions import geom as g
from . import chains, fills

FILL_RULES = ("evenOdd", "nonZero", "positive", "negative")


def to_cells(df, view, geom="geom"):
    """Map geometry to cell coordinates of a view ``(width, height, box)``, y down."""
    w, h, (minx, miny, maxx, maxy) = view
    if w <= 0 or h <= 0:
        raise ValueError("width and height must be greater than zero")
    return df.withColumn("_cells", g.map_vertices(geom, lambda x, y: (
        (x - minx) * w / (maxx - minx), (F.lit(float(maxy)) - y) * h / (maxy - miny),
    )))


def point_cells(df, width, height, keep, geom="_cells"):
    pts = df.where(F.col(geom)["type"].isin(g.POINT, g.MULTIPOINT)).select(*keep, F.explode(g.vertices(geom)).alias("_v"))
    return pts.select(*keep, F.floor("_v.x").alias("x"), F.floor("_v.y").alias("y")).where(
        F.col("x").between(0, width - 1) & F.col("y").between(0, height - 1)
    )


def line_cells(df, width, height, keep, geom="_cells"):
    """Cells on equally spaced steps along each segment, one step per cell of its longer axis.

    Steps outside the canvas are not generated.
    """
    lines = df.where(F.col(geom)["type"].isin(g.LINE, g.MULTILINE))
    segs = F.flatten(F.transform(F.flatten(F.col(geom)["parts"]), g.segments))
    s = lines.select(*keep, F.explode(segs).alias("s")).select(
        *keep, F.col("s.a.x").alias("_ax"), F.col("s.a.y").alias("_ay"), (F.col("s.b.x") - F.col("s.a.x")).alias("_dx"), (F.col("s.b.y") - F.col("s.a.y")).alias("_dy"),
    )
    n = F.greatest(F.ceil(F.greatest(F.abs("_dx"), F.abs("_dy"))), F.lit(1))
    lo, hi = F.lit(0.0), F.lit(1.0)
    for a, d, limit in (("_ax", "_dx", width), ("_ay", "_dy", height)):
        a, d = F.col(a), F.col(d)
        safe = F.when(d == 0, F.lit(1.0)).otherwise(d)
        t0, t1 = (F.lit(0.0) - a) / safe, (F.lit(float(limit)) - a) / safe
        lo = F.when(d == 0, lo).otherwise(F.greatest(lo, F.least(t0, t1)))
        hi = F.when(d == 0, hi).otherwise(F.least(hi, F.greatest(t0, t1)))
    # one step more on both sides; the exact test on the cell follows
    i0, i1 = F.greatest(F.floor(lo * F.col("_n")) - 1, F.lit(0)), F.least(F.ceil(hi * F.col("_n")) + 1, F.col("_n"))
    steps = s.withColumn("_n", n).where(lo <= hi).withColumn("_i", F.explode(F.sequence(i0, i1)))
    at = lambda a, d: F.floor(F.col(a) + F.col(d) * F.col("_i") / F.col("_n"))
    return steps.select(*keep, at("_ax", "_dx").alias("x"), at("_ay", "_dy").alias("y")).where(
        F.col("x").between(0, width - 1) & F.col("y").between(0, height - 1)
    )


def _inside(rule):
    w = F.col("_w")
    if rule == "evenOdd":
        return F.pmod(w, F.lit(2)) == 1
    if rule == "nonZero":
        return w != 0
    if rule == "positive":
        return w > 0
    if rule == "negative":
        return w < 0
    raise ValueError(f"fill rule is one of {FILL_RULES}")


def polygon_cells(df, width, height, keep, rule="evenOdd", by_part=False, geom="_cells"):
    """Cells whose centre lies inside under a fill rule.

    Each edge gives one crossing per cell row it spans; sorted along the row, a
    running sum of directions is the winding number of every span. The crossings
    of a batch of features are sorted in Python, a bounded number at once, so no
    task sorts all of its crossings. Shells count +1 and holes -1 whichever way
    they are drawn. Each row is a feature. A list of rules is tested on the same
    winding numbers, and each cell names its ``rule``.
    """
    rules = [rule] if isinstance(rule, str) else list(rule)
    inside = F.array_compact(F.array(*[F.when(_inside(r), F.lit(r)) for r in rules]))
    keep = list(keep)
    polys = df.where(F.col(geom)["type"].isin(g.POLYGON, g.MULTIPOLYGON)).select(*keep, F.col(geom).alias("_shape"))
    chains.bound_batches(df.sparkSession)
    schema = StructType([*polys.select(*keep).schema.fields, *[StructField(c, IntegerType() if c == "part" else LongType()) for c in ("part", "y", "_c0", "_c1", "_w")]])
    spans = polys.mapInArrow(fills.in_batches(polys.columns[:-1], width, height, by_part), schema).withColumn("_rules", inside).where(F.size("_rules") > 0)
    if not isinstance(rule, str):
        spans = spans.withColumn("rule", F.explode("_rules"))
        keep.append("rule")
    return spans.withColumn("x", F.explode(F.sequence("_c0", "_c1"))).select(*keep, *(["part"] if by_part else []), "x", "y")


def all_cells(df, width, height, keep, rule="evenOdd", geom="_cells"):
    """Cells of every kind of geometry."""
    out = point_cells(df, width, height, keep, geom)
    out = out.unionByName(line_cells(df, width, height, keep, geom))
    return out.unionByName(polygon_cells(df, width, height, keep, rule, False, geom))


def fill_rule_cover(df, width, height, rule, keep=("fid",), geom="_cells"):
    """Interior of every polygon part by itself (T13); a list of rules is answered in one pass, with a ``rule`` column."""
    return polygon_cells(df, width, height, list(keep), rule, True, geom)


def union_cover(df, width, height, rule="positive", union=True, keep=("fid",), geom="_cells"):
    """Multi-polygon union as coverage (T14): off keeps parts apart; on counts overlap once,
    or makes it a hole under evenOdd."""
    return polygon_cells(df, width, height, list(keep), rule, not union, geom)


def last_drawn(cells, by, value):
    """The value of the last drawn feature of each cell: by layer, then by feature id.

    In two steps of single columns, not by a pair of them: numbers are then kept in a hash table of cells, where a pair
    would have every cell of every feature sorted.
    """
    if cells.schema["fid"].dataType.simpleString() not in ("bigint", "int"):
        return cells.groupBy(*by).agg(F.max_by(value, F.struct("layer_ord", "fid")).alias(value))
    number = F.coalesce(F.col("fid").cast("bigint"), F.lit(-(2**63)).cast("bigint"))  # those without an id come first
    rows = cells.select(*by, F.coalesce("layer_ord", F.lit(-(2**31))).alias("_layer"), number.alias("_n"), value)
    layers = rows.groupBy(*by, "_layer").agg(F.max_by(value, "_n").alias(value))
    return layers.groupBy(*by).agg(F.max_by(value, "_layer").alias(value))
