"""Douglas-Peucker: equal to a plain recursion, whichever way it goes, and in time that follows the length."""

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartoloom.functions import geom as g
from cartoloom.operators import chains, tiles


def plain(line, distance):
    """Places of the vertices that stay."""
    stay, todo = {0, len(line) - 1}, [(0, len(line) - 1)]
    while todo:
        low, high = todo.pop()
        (ax, ay), (bx, by) = line[low], line[high]
        best, at = -1.0, None
        for i in range(low + 1, high):
            x, y = line[i]
            size = (bx - ax) ** 2 + (by - ay) ** 2
            t = 0.0 if size == 0 else min(max(((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / size, 0.0), 1.0)
            d = math.sqrt((ax + t * (bx - ax) - x) ** 2 + (ay + t * (by - ay) - y) ** 2)
            if d > best:
                best, at = d, i
        if at is not None and best > distance:
            stay.add(at)
            todo += [(low, at), (at, high)]
    return sorted(stay)


def spiral(n):
    """Nearly every split leaves one vertex on a side."""
    return [(round((1 + 0.002 * k) * math.cos(k / 9) * 50), round((1 + 0.002 * k) * math.sin(k / 9) * 50)) for k in range(n)]


def wander(seed, n, step=9):
    rng, out = random.Random(seed), [(0, 0)]
    for _ in range(n - 1):
        out.append((out[-1][0] + rng.randint(-step, step), out[-1][1] + rng.randint(-step, step)))
    return out


LINES = [wander(1, 700), wander(2, 900, 1), spiral(900), [(k % 2, 0) for k in range(600)], [(k, 0) for k in range(600)], wander(3, 800) + [(0, 0)], [(5, 5)] * 500, [(0, 0), (9, 9)], [(1, 1)]]


@pytest.mark.parametrize("plainly", [32, 0])
@pytest.mark.parametrize("distance", [0.5, 3.0, 20.0])
def test_flags_equal_the_recursion(monkeypatch, plainly, distance):
    monkeypatch.setattr(chains, "PLAIN", plainly)
    for line in LINES:
        xs, ys = (np.array([v[k] for v in line], float) for k in (0, 1))
        assert list(np.flatnonzero(chains.kept(xs, ys, np.array([0]), np.array([len(line) - 1]), distance))) == plain(line, distance)


def frame(spark, shapes):
    rows = [(1, (t, [[[(float(x), float(y)) for x, y in ring] for ring in part] for part in parts]) if t else None) for t, parts in shapes]
    return spark.createDataFrame(rows, f"fid long, tgeom {g.GEOM_TYPE}").withColumn("at", F.monotonically_increasing_id()).coalesce(1)


def test_features_keep_rows_types_and_parts(spark):
    square = [(0, 0), (50, 1), (100, 0), (100, 100), (0, 100), (0, 0)]
    shapes = [
        (g.LINE, [[LINES[0]]]), (None, None), (g.MULTIPOINT, [[[(0, 0)]], [[(0, 1)]], [[(0, 2)]]]), (g.POINT, [[[(3, 4)]]]), (g.LINE, []),
        (g.MULTILINE, [[LINES[1]], [LINES[2]]]), (g.POLYGON, [[square, [(10, 10), (20, 10), (20, 20), (10, 10)]]]), (g.MULTIPOLYGON, [[square], [square]]),
    ]
    got = [r["tgeom"] for r in tiles.simplify(frame(spark, shapes), 3.0).orderBy("at").collect()]
    for shape, (kind, parts) in zip(got, shapes):
        if kind is None:
            assert shape is None
            continue
        thin = kind not in (g.POINT, g.MULTIPOINT)
        want = [[[line[i] for i in plain(line, 3.0)] if thin else line for line in part] for part in parts]
        assert shape["type"] == kind and [[[tuple(v) for v in line] for line in part] for part in shape["parts"]] == want
    assert tiles.simplify(frame(spark, shapes).limit(0), 3.0).collect() == []


@pytest.mark.parametrize("chain", [60, 1_000_000])
def test_vertices_of_long_chains_are_split_by_rounds(spark, chain):
    lines = [LINES[0][:200], LINES[5][:150] + [(0, 0)], [(0, 0), (4, 4)], [(2, 2)]]
    rows = [(fid, 0, 0, seq, float(x), float(y)) for fid, line in enumerate(lines) for seq, (x, y) in enumerate(line)]
    table = spark.createDataFrame(rows, "fid long, part int, ring int, seq int, vx double, vy double")
    got = {}
    for r in tiles.simplify_vertices(table, 12.0, chain=chain).collect():
        got.setdefault(r["fid"], []).append(r["seq"])
    assert {k: sorted(v) for k, v in got.items()} == {k: plain(line, 12.0) for k, line in enumerate(lines)}


def test_spirals_take_time_by_length():
    def seconds(n):
        xs, ys = (np.array([v[k] for v in spiral(n)], float) for k in (0, 1))
        start = time.perf_counter()
        stay = chains.kept(xs, ys, np.array([0]), np.array([n - 1]), 0.5)
        assert stay.sum() > n / 2
        return time.perf_counter() - start

    seconds(1_000)
    short, long = seconds(10_000), seconds(40_000)
    assert long < 8 * short
