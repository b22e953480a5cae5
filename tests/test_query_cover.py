"""Point queries on covered polygons and walked lines, against every pair."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cartoloom.functions import geom as g
from cartoloom.functions import mercator as m
from cartoloom.operators import query as q

WORLD = m.HALF_WORLD
SCHEMA = f"layer string, fid long, name string, geom {g.GEOM_TYPE}"


def features(spark, rows):
    """(fid, name, type, parts) with vertices as (x, y)."""
    shaped = [("l", fid, name, (t, [[[(float(x), float(y)) for x, y in ring] for ring in part] for part in parts])) for fid, name, t, parts in rows]
    return g.with_bounds(spark.createDataFrame(shaped, SCHEMA))


def star(rng, x, y, size, corners):
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(corners))
    ring = [(x + math.cos(a) * size * rng.uniform(0.2, 1), y + math.sin(a) * size * rng.uniform(0.2, 1)) for a in angles]
    return [*ring, ring[0]]


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


def points(spark, places):
    lon = lambda x: x / WORLD * 180
    lat = lambda y: math.degrees(2 * math.atan(math.exp(y / m.RADIUS)) - math.pi / 2)
    return spark.createDataFrame([(i, lon(x), lat(y)) for i, (x, y) in enumerate(places)], "pid long, lon double, lat double")


def every_pair(pts, shapes, tolerance):
    at = pts.select("pid", m.merc_x("lon").alias("px"), m.merc_y("lat").alias("py"))
    pairs = at.join(F.broadcast(shapes)).withColumn("d", g.geometry_hit("geom", "px", "py")["distance"]).where(F.col("d").between(0, tolerance))
    return sorted((r["pid"], r["fid"], r["name"], round(r["d"], 6)) for r in pairs.select("pid", "fid", "name", "d").collect())


def found(pts, shapes, tolerance):
    rows = q.query_many(pts, shapes, tolerance).select("pid", "fid", "name", "distance").collect()
    return sorted((r["pid"], r["fid"], r["name"], round(r["distance"], 6)) for r in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_polygons_equal_every_pair(spark, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(40):
        size = 10 ** rng.uniform(3.5, 7.2)
        x, y = rng.uniform(-1.5e7, 1.5e7), rng.uniform(-1.5e7, 1.5e7)
        part = [star(rng, x, y, size, rng.randint(3, 60))]
        if k % 3 == 0:
            part += [star(rng, x, y, size / 3, 5), box(x - size / 2, y - size / 9, x + size, y), [(x, y), (x + 1, y), (x, y)]]
        rows.append((k, "a", g.POLYGON, [part]))
    rows.append((100, "multi", g.MULTIPOLYGON, [[star(rng, 0, 0, 9e6, 30)], [star(rng, 3e6, 3e6, 9e6, 7), box(0, 0, 5e6, 5e6)], [[(0, 0), (1, 1), (0, 0)]]]))
    rows.append((101, "world", g.POLYGON, [[box(-WORLD, -WORLD, WORLD, WORLD)]]))
    rows.append((102, "cells", g.POLYGON, [[box(-WORLD / 2, -WORLD / 4, WORLD / 2, WORLD / 8), box(0, 0, WORLD / 4, WORLD / 16)]]))
    places = [(rng.uniform(-1.9e7, 1.9e7), rng.uniform(-1.9e7, 1.9e7)) for _ in range(1_200)]
    places += [(x * WORLD / 16, y * WORLD / 16) for x in range(-15, 16, 3) for y in range(-15, 16, 3)]  # on the borders of cells
    places += [v for row in rows for part in row[3] for ring in part for v in ring[:6] if abs(v[0]) < 1.99e7 and abs(v[1]) < 1.99e7]
    shapes, pts = features(spark, rows), points(spark, places)
    got = found(pts, shapes, 0.0)
    assert got == every_pair(pts, shapes, 0.0) and len(got) > 1_000


@pytest.mark.parametrize("tolerance", [0.0, 5_000.0, 3_000_000.0])
def test_lines_equal_every_pair(spark, tolerance):
    rng = random.Random(7)
    rows = []
    for k in range(60):
        size = 10 ** rng.uniform(2, 7)
        x, y = rng.uniform(-1e7, 1e7), rng.uniform(-1e7, 1e7)
        rows.append((k, "a", g.LINE, [[[(x + rng.uniform(-size, size), y + rng.uniform(-size, size)) for _ in range(rng.randint(1, 6))]]]))
    rows += [(200, "up", g.LINE, [[[(0, -WORLD), (0, WORLD)]]]), (201, "across", g.MULTILINE, [[[(-WORLD, 0), (WORLD, 0)]], [[(-WORLD, 1e6), (WORLD, 1e6)]]]), (202, "point", g.LINE, [[[(5, 5), (5, 5)]]])]
    rows += [(300, "one", g.LINE, [[[(0, 0), (1e6, 1e6)]]]), (300, "two", g.LINE, [[[(0, 0), (1e6, 1e6)]]])]  # equal but for a field
    places = [(rng.uniform(-1.2e7, 1.2e7), rng.uniform(-1.2e7, 1.2e7)) for _ in range(600)]
    places += [(0, y * WORLD / 16) for y in range(-15, 16)] + [(5, 5), (0, 0), (500_000, 500_000)]
    shapes, pts = features(spark, rows), points(spark, places)
    got, want = found(pts, shapes, tolerance), every_pair(pts, shapes, tolerance)
    assert [r[:3] for r in got] == [r[:3] for r in want] and all(abs(a[3] - b[3]) < 1e-3 for a, b in zip(got, want)) and len(got) > 5


def test_candidates_stay_near_the_hits(spark):
    """World-sized slivers: their envelopes hold all points, their covers few more than the hits."""
    rows = [(k, "a", g.POLYGON, [[[(-1.9e7, -1.9e7 + k * 1e5), (1.9e7, 1.8e7 + k * 1e5), (1.9e7, 1.9e7 + k * 1e5), (-1.9e7, -1.9e7 + k * 1e5)]]]) for k in range(-4, 1)]
    rng = random.Random(3)
    pts = points(spark, [(rng.uniform(-1.9e7, 1.9e7), rng.uniform(-1.9e7, 1.9e7)) for _ in range(4_000)])
    shapes = features(spark, rows).withColumn("shape", q.shape_of("geom"))
    at = pts.select("pid", m.merc_x("lon").alias("_px"), m.merc_y("lat").alias("_py"))
    levels = q._levels_in_use(shapes, F.lit(2), 0.0)[2]
    pairs = q._points_in_cells(at, levels).join(q._polygon_cells(shapes, ["fid"]), "_cell").count()
    hits = q.query_many(pts, shapes.drop("shape"), 0.0).count()
    assert hits < pairs < 5_000 < 5 * 4_000
    cells = q._polygon_cells(features(spark, [(1, "b", g.POLYGON, [[box(-1.9e7, -1.9e7, 1.9e7, 1.9e7)]])]), ["fid"])
    sure = cells.where("_inside").count()
    assert sure > 0.8 * cells.count() and cells.agg(F.max(F.size("_open.edges"))).first()[0] <= 4


def test_kinds_together_and_no_rows(spark):
    rows = [(1, "p", g.POINT, [[[(10, 10)]]]), (2, "l", g.LINE, [[[(0, 0), (1e5, 0)]]]), (3, "a", g.POLYGON, [[box(-1e6, -1e6, 1e6, 1e6)]]), (4, "m", g.MULTIPOINT, [[[(5, 5)]], [[(2e5, 2e5)]]])]
    shapes, pts = features(spark, rows), points(spark, [(0, 0), (9e6, 9e6), (1.1e5, 1.0)])
    assert found(pts, shapes, 50.0) == every_pair(pts, shapes, 50.0)
    assert found(pts, shapes.limit(0), 50.0) == [] and found(pts.limit(0), shapes, 50.0) == []
    with pytest.raises(ValueError):
        q.query_many(pts, shapes, 1.0, layer="none")


def test_hit_features_by_shape(spark):
    """Two features of one id: only the one that was hit comes back."""
    shapes = features(spark, [(1, "near", g.POINT, [[[(0, 0)]]]), (1, "far", g.POINT, [[[(9e6, 9e6)]]]), (2, "none", g.POINT, [[[(5e6, 0)]]])])
    hits = q.query_many(points(spark, [(1, 1)]), shapes, 10.0)
    assert [(r["name"], r["feature_id"]) for r in q.hit_features(shapes, hits).collect()] == [("near", 0)]
    assert sorted(r["name"] for r in q.hit_features(shapes, hits.drop("shape")).collect()) == ["far", "near"]


def test_searches_in_rounds(spark):
    """Nearest hits, misses and hit features found in rounds are those of all hits; points with a hit leave early."""
    rng = random.Random(8)
    rows = [(i, "p", g.POINT, [[[(rng.randint(-40, 40) * 250, rng.randint(-40, 40) * 250)]]]) for i in range(150)]
    rows += [(200 + i, "l", g.LINE, [[[(i * 3e4, 3e4), (i * 3e4 + 9e3, 5e4)]]]) for i in range(3)]
    rows += [(300, "a", g.POLYGON, [[box(-2e5, -2e5, -1e5, -1e5)]]), (7, "p", g.POINT, [[[(9e6, 9e6)]]])]
    shapes = features(spark, rows)
    pts = points(spark, [(rng.uniform(-2e5, 2e5), rng.uniform(-2e5, 2e5)) for _ in range(60)] + [(x * 250, x * 125) for x in range(-30, 30)])
    for tolerance in (20_000.0, 0.0):
        hits = q.query_many(pts, shapes, tolerance, fields=[])
        same = lambda a, b: sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
        assert same(q.nearest_many(pts, shapes, tolerance), q.nearest_hit(hits))
        assert same(q.unhit_points(pts, shapes, tolerance).select("pid"), q.miss_points(pts, hits).select("pid"))
        ids = ["name", "fid", "feature_id"]
        assert same(q.touched_features(pts, shapes, tolerance).select(*ids), q.hit_features(shapes, hits).select(*ids))


def test_dense_features_meet_few_points(spark, monkeypatch):
    """In a dense place a point meets the features nearby only: hits made are far fewer than the pairs within the tolerance."""
    at = [(x * 200.0, y * 200.0) for x in range(40) for y in range(40)]
    shapes, pts = features(spark, [(i, "p", g.POINT, [[[p]]]) for i, p in enumerate(at)]), points(spark, at[::7])
    made, plain = [], q.query_many
    monkeypatch.setattr(q, "query_many", lambda *a, **k: made.append(plain(*a, **k)) or made[-1])
    assert q.unhit_points(pts, shapes, 8_000.0).count() == 0 and q.nearest_many(pts, shapes, 8_000.0).count() == pts.count()
    assert 10 * sum(h.count() for h in made) < plain(pts, shapes, 8_000.0).count()
