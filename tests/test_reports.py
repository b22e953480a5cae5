"""Crossings found cell by cell, against every pair of segments, and rings that cross in a vertex."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cartoloom.functions import geom as g
from cartoloom.operators import reports

SCHEMA = f"layer string, fid long, tgeom {g.GEOM_TYPE}"


def frame(spark, rows):
    return spark.createDataFrame([("l", fid, (t, [[[(float(x), float(y)) for x, y in ring] for ring in part] for part in parts])) for fid, t, parts in rows], SCHEMA)


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


def side(p, q, r):
    d = (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    return (d > 0) - (d < 0)


def meets(a, b, c, d):
    on = lambda p, q, r: min(p[0], q[0]) <= r[0] <= max(p[0], q[0]) and min(p[1], q[1]) <= r[1] <= max(p[1], q[1])
    s = side(a, b, c), side(a, b, d), side(c, d, a), side(c, d, b)
    return (s[0] * s[1] < 0 and s[2] * s[3] < 0) or (s[0] == 0 and on(a, b, c)) or (s[1] == 0 and on(a, b, d)) or (s[2] == 0 and on(c, d, a)) or (s[3] == 0 and on(c, d, b))


def line_pairs(line):
    """Segments of an open line that meet other than as neighbours."""
    segs = list(zip(line, line[1:]))
    out = set()
    for j, (c, d) in enumerate(segs):
        for i, (a, b) in enumerate(segs[:j]):
            if i == 0 and j == len(segs) - 1 and a == d and j > 1:
                continue
            if j == i + 1:
                if side(a, b, d) == 0 and (a[0] - b[0]) * (d[0] - b[0]) + (a[1] - b[1]) * (d[1] - b[1]) > 0:
                    out.add((i, j))
            elif meets(a, b, c, d):
                out.add((i, j))
    return out


def test_pairs_of_lines(spark):
    rng = random.Random(1)
    rows = []
    for fid in range(12):
        size, step = (20, 20) if fid % 2 else (4_000, 150)
        at, line = (rng.randint(0, size), rng.randint(0, size)), []
        for _ in range(60):
            line.append(at)
            at = (at[0] + rng.randint(-step, step), at[1] + (0 if fid % 5 == 4 else rng.randint(-step, step)))
        rows.append((fid, g.LINE, [[line]]))
    rows.append((50, g.LINE, [[[(0, 0), (0, 0), (5, 5)]]]))
    rows.append((51, g.LINE, [[[(x * 10, (x % 2) * 3_000) for x in range(80)] + [(400, 1_500), (-10, 1_500)]]]))
    rows.append((52, g.LINE, [[[(7, y) for y in range(30)] + [(7, 10)]]]))
    got = {}
    pairs = [(r["fid"], r["a"]["seg"], r["b"]["seg"]) for r in reports.crossing_pairs(reports.segment_table(frame(spark, rows))).collect()]
    assert len(pairs) == len(set(pairs))  # each in one cell
    for fid, i, j in pairs:
        got.setdefault(fid, set()).add((i, j))
    for fid, _, parts in rows:
        line = [(float(x), float(y)) for x, y in parts[0][0]]
        if fid != 50:
            assert got.get(fid, set()) == line_pairs(line), fid


def saw(n):
    """A ring of long, steep teeth."""
    top = [(k, 3_000 + (k % 2) * 50_000) for k in range(n)]
    return [*[(k, 0) for k in (n - 1, 0)], *top, (n - 1, 0)]


def star(n):
    ring = [(round(math.cos(2 * math.pi * k / n) * (1_000_000 if k % 2 else 900_000)), round(math.sin(2 * math.pi * k / n) * (1_000_000 if k % 2 else 900_000))) for k in range(n)]
    return [*ring, ring[0]]


@pytest.mark.parametrize("ring", [saw(20_000), star(20_000)], ids=["saw", "star"])
def test_rows_are_linear(spark, ring):
    table = reports.segment_table(frame(spark, [(1, g.POLYGON, [[ring]])]))
    cells = reports.segment_cells(table)
    assert cells.count() <= 6 * len(ring)
    assert cells.groupBy("_cx", "_cy").count().agg(F.max("count")).first()[0] <= len(ring) / 50
    assert reports.crossing_pairs(table).count() == 0


SHELL = box(0, 0, 20, 20)
VERTEX = [
    # (rings of one polygon, whether they cross)
    ([SHELL, box(5, 5, 9, 9)], False),
    ([SHELL, [(0, 0), (5, 9), (9, 5), (0, 0)]], False),  # touches from inside, in a vertex of both
    ([SHELL, [(0, 10), (5, 9), (9, 15), (0, 10)]], False),  # touches an edge with a vertex
    ([SHELL, [(10, 10), (0, 0), (-5, -9), (-9, -5), (0, 0), (10, 10)]], True),  # out through the corner and back
    ([SHELL, [(5, 9), (0, 0), (-5, 5), (-3, 12), (5, 9)]], True),  # out through the corner
    ([[(0, 0), (10, -5), (20, 0), (20, 20), (0, 20), (0, 0)], [(10, 5), (10, -5), (12, -9), (15, 5), (10, 5)]], True),  # through a vertex and an edge
    ([SHELL, [(5, 10), (0, 12), (-5, 10), (0, 8), (5, 10)]], True),  # vertices on one edge, both ways through
    ([SHELL, [(5, 10), (0, 12), (3, 10), (0, 8), (5, 10)]], False),  # touches one edge twice from inside
    ([[(0, 0), (20, 0), (20, 20), (10, 5), (0, 20), (0, 0)], [(10, 5), (8, 2), (12, 2), (10, 5)]], False),  # touches a notch
    ([[(0, 0), (20, 0), (20, 20), (10, 5), (0, 20), (0, 0)], [(10, 5), (10, 15), (12, 2), (10, 5)]], True),  # one side in the notch
    ([SHELL, [(5, 5), (5, 0), (9, 0), (9, 5), (5, 5)]], True),  # shares a stretch
]


@pytest.mark.parametrize("rings,crosses", VERTEX)
def test_rings_in_a_vertex(spark, rings, crosses):
    forms = [rings, [rings[0], rings[1][::-1]], [[(y, x) for x, y in r] for r in rings]]
    k = len(rings[1]) // 2
    forms.append([rings[0], [*rings[1][k:-1], *rings[1][: k + 1]]])  # another first vertex
    rows = [(i, g.POLYGON, [f]) for i, f in enumerate(forms)]
    table = reports.segment_table(frame(spark, rows))
    found = {r["fid"] for r in reports.crossing_pairs(table).where("a.ring <> b.ring").select("fid").distinct().collect()}
    assert found == (set(range(len(forms))) if crosses else set())


def test_validity_of_parts(spark):
    """Parts are reported one by one with split_multi, in the projection asked for."""
    good, bow = [box(0, 0, 100, 100), box(10, 10, 50, 50)[::-1]], [[(200, 0), (300, 100), (300, 0), (200, 100), (200, 0)]]
    out = [box(400, 0, 500, 100), [(450, 50), (400, 0), (350, -20), (380, 50), (450, 50)]]
    rows = frame(spark, [(1, g.MULTIPOLYGON, [good, bow, out]), (2, g.MULTIPOLYGON, [good])]).withColumns({c: F.lit(0) for c in "zxy"})
    whole = reports.validity_report(rows, keys=("layer", "fid", "z", "x", "y")).where("message = 'self-intersection'").collect()
    assert [r["fid"] for r in whole] == [1]
    for options in ({}, {"lat_lon": True}, {"web_merc": True}):
        split = reports.validity_report(rows, keys=("layer", "fid", "z", "x", "y"), split_multi=True, **options)
        texts = [r["geojson"] for r in split.where("message = 'self-intersection'").collect()]
        assert len(texts) == 2 and all('"Polygon"' in t for t in texts)
        if not options:
            assert any("300" in t for t in texts) and any("450" in t for t in texts)


def test_small_geometries_in_their_row(spark):
    """Pairs compared in the row and by cells report the same geometries, and small ones need no cells."""
    rng = random.Random(3)
    rows = []
    for fid in range(300):
        ring = lambda k: [(rng.randint(0, 12), rng.randint(0, 12)) for _ in range(k)]
        rings = [(lambda r: [*r, r[0]])(ring(rng.randint(3, 5))) for _ in range(1 + fid % 2)]
        rows.append((fid, g.LINE, [[ring(rng.randint(1, 6))]]) if fid % 3 == 0 else (fid, g.POLYGON, [rings]))
    rows += [(fid + 1000, g.POLYGON, [f]) for fid, (f, _) in enumerate(VERTEX)]
    shapes = frame(spark, rows)
    by_cells = {r["fid"] for r in reports.crossing_pairs(reports.segment_table(shapes)).select("fid").distinct().collect()}
    assert {r["fid"] for r in shapes.where(reports.crosses_itself("tgeom")).collect()} == by_cells
    assert {r["fid"] for r in reports.simplicity_report(shapes).collect()} == by_cells
    areal = {fid for fid, t, _ in rows if t == g.POLYGON}
    valid = reports.validity_report(shapes)
    assert {r["fid"] for r in valid.where("message = 'self-intersection'").collect()} == by_cells & areal


def test_geometries_over_the_row_limit(spark):
    """A bow tie with more vertices than are compared in a row is found by cells."""
    bow = [(0, 0), *[(k, k) for k in range(1, 100)], (100, 0), *[(100 - k, k) for k in range(1, 100)], (0, 100), (0, 0)]
    rows = frame(spark, [(1, g.POLYGON, [[bow]]), (2, g.POLYGON, [[star(200)]])])
    assert [r["fid"] for r in reports.validity_report(rows).where("message = 'self-intersection'").collect()] == [1]
    assert [r["fid"] for r in reports.simplicity_report(rows).collect()] == [1]


def test_texts_of_one_search(spark):
    """Texts in several projections come from one search and equal those of single reports."""
    bow = [[(200, 0), (300, 100), (300, 0), (200, 100), (200, 0)]]
    rows = frame(spark, [(1, g.MULTIPOLYGON, [[box(0, 0, 9, 9)], bow])]).withColumns({c: F.lit(0) for c in "zxy"})
    both = reports.validity_texts(rows, {"degrees": 4326, "metres": 3857}, split_multi=True)
    for name, options in (("degrees", {"lat_lon": True}), ("metres", {"web_merc": True})):
        alone = reports.validity_report(rows, split_multi=True, **options)
        assert sorted(r[name] for r in both.collect()) == sorted(r["geojson"] for r in alone.collect()) != []
