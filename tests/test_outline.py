"""Rings around covered cells against the cells, and tiles with unions and fill rules."""

import random

import pytest
from pyspark.sql import functions as F

from cartoloom.functions import geom as g
from cartoloom.operators import burn, outline, tiles

SIDE = 40


def frame(spark, shapes):
    return spark.createDataFrame([(f, x, y) for f, cells in shapes.items() for x, y in cells], "fid bigint, x int, y int")


def drawn(spark, shapes):
    return outline.cover_rings(frame(spark, shapes), ["fid"])


def parts(row):
    return [[[(v["x"], v["y"]) for v in ring] for ring in part] for part in row["_cells"]["parts"]]


def area(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2


def pieces(cells):
    """Number of groups of cells that share sides."""
    left, n = set(cells), 0
    while left:
        todo, n = [left.pop()], n + 1
        while todo:
            x, y = todo.pop()
            for c in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if c in left:
                    left.remove(c)
                    todo.append(c)
    return n


def spiral(n):
    """A path of cells that winds inwards."""
    x, y, dx, dy, seen = 0, 0, 1, 0, set()
    free = lambda a, b: 0 <= a < n and 0 <= b < n and (a, b) not in seen
    while True:
        seen.add((x, y))
        ahead = free(x + dx, y + dy) and (x + 2 * dx, y + 2 * dy) not in seen
        if not ahead:
            dx, dy = -dy, dx
            if not free(x + dx, y + dy) or (x + 2 * dx, y + 2 * dy) in seen:
                return seen
        x, y = x + dx, y + dy


def test_rings_fill_to_their_cells(spark):
    rng = random.Random(11)
    shapes = {i: {(rng.randrange(SIDE), rng.randrange(SIDE)) for _ in range(n)} for i, n in enumerate((1, 60, 400, 900, 1400))}
    full = {(x, y) for x in range(SIDE) for y in range(SIDE)}
    shapes[10] = full
    shapes[11] = {(x, y) for x, y in full if min(x, y, SIDE - 1 - x, SIDE - 1 - y) % 4 < 2}  # frames in frames
    shapes[12] = {(x, y) for x, y in full if (x + y) % 2}  # cells that touch in corners only
    shapes[13] = {(x, y) for x, y in full if x % 3 or y % 3}  # many holes of one shell
    shapes[14] = spiral(SIDE)
    out = drawn(spark, shapes).cache()
    filled = {}
    for r in burn.polygon_cells(out, SIDE, SIDE, ["fid"], "positive", True).collect():
        assert (r["x"], r["y"]) not in filled.setdefault(r["fid"], set())
        filled[r["fid"]].add((r["x"], r["y"]))
    assert filled == shapes
    for row in out.collect():
        cells, own = shapes[row["fid"]], parts(row)
        assert len(own) == pieces(cells)
        assert sum(area(r) for p in own for r in p) == len(cells)
        assert all(area(p[0]) > 0 and all(area(r) < 0 for r in p[1:]) for p in own)
        for ring in (r for p in own for r in p):
            assert ring[0] == ring[-1] and len(ring) % 2 == 1  # corners alternate, none lies on a side
            assert all((a[0] == b[0]) != (a[1] == b[1]) for a, b in zip(ring, ring[1:]))
    assert [parts(r) for r in out.where("fid = 10").collect()] == [[[[(0, 0), (SIDE, 0), (SIDE, SIDE), (0, SIDE), (0, 0)]]]]


def test_no_cells_repeated_cells_and_null_keys(spark):
    assert drawn(spark, {1: []}).isEmpty()
    cells = [(None, 0, 0), (None, 0, 0), (None, 1, 0), (2, 5, 5)]
    out = outline.cover_rings(spark.createDataFrame(cells, "fid bigint, x int, y int"), ["fid"])
    assert {r["fid"]: parts(r) for r in out.collect()} == {
        None: [[[(0, 0), (2, 0), (2, 1), (0, 1), (0, 0)]]], 2: [[[(5, 5), (6, 5), (6, 6), (5, 6), (5, 5)]]]}


def squares(spark):
    """Two overlapping squares as one multipolygon, in mercator, and a point."""
    q = 20037508.342789244 / 2
    ring = lambda lo, hi: [{"x": float(x), "y": float(y)} for x, y in ((lo, lo), (hi, lo), (hi, hi), (lo, hi), (lo, lo))]
    both = [[ring(-q, q)], [ring(0, 1.5 * q)]]
    spot = [[[{"x": q, "y": q}]]]
    df = spark.createDataFrame([("p", 0, 1, (g.MULTIPOLYGON, both)), ("p", 0, 2, (g.POINT, spot))], f"layer string, layer_ord int, fid bigint, geom {g.GEOM_TYPE}")
    return g.with_bounds(df)


def test_tiles_with_union_and_fill_rule(spark):
    def built(**opts):
        rows = {r["fid"]: r for r in tiles.tile_from_features(squares(spark), 0, **opts).collect()}
        assert rows[2]["gtype"] == 1
        return [[abs(area([(v["x"], v["y"]) for v in ring])) for ring in part] for part in rows[1]["tgeom"]["parts"]]

    one, two, both = 2048.0**2, 1536.0**2, 1024.0**2
    assert built() == [[one], [two]]
    assert built(fill_type="evenOdd") == [[one], [two]]  # each part by itself
    assert built(multi_polygon_union=True) == [[one + two - both]]
    assert built(multi_polygon_union=True, fill_type="nonZero") == [[one + two - both]]
    assert sum(a for part in built(multi_polygon_union=True, fill_type="evenOdd") for a in (part[0], *(-r for r in part[1:]))) == one + two - 2 * both
    assert tiles.tile_from_features(squares(spark).where("fid = 1"), 0, multi_polygon_union=True, fill_type="negative").isEmpty()
    with pytest.raises(ValueError):
        built(fill_type="odd")
    with pytest.raises(ValueError):
        built(multi_polygon_union=True, cover_cells=100)
    # every tile of a deeper zoom
    at2 = tiles.tile_from_features(squares(spark).where("fid = 1"), 2, multi_polygon_union=True, buffer=0)
    total = at2.select(F.aggregate(F.flatten("tgeom.parts"), F.lit(0.0), lambda t, r: t + g.ring_area(r)).alias("a")).agg(F.sum("a")).first()[0]
    assert total == (one + two - both) * 16


def test_rings_are_joined_without_a_broadcast(spark, monkeypatch, tmp_path):
    """Sides are far more than their estimate, so no join of theirs may send them through the driver."""
    kept, plans = outline.skew.checkpoint, []

    def held(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df)

    monkeypatch.setattr(outline.skew, "checkpoint", held)
    frame(spark, {1: [(x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)]}).write.parquet(f"{tmp_path}/cells")
    rings = outline.cover_rings(spark.read.parquet(f"{tmp_path}/cells"))  # files have a size to estimate from
    plans.append(rings._jdf.queryExecution().executedPlan().toString())
    assert rings.count() == 1
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)
