"""Counts of lines near points, without the hits, against every pair."""

import random

import numpy as np
from pyspark.sql import functions as F

from cartoloom.functions import geom as g
from cartoloom.operators import query as q
from cartoloom.operators import reach

from test_query_cover import features, points


def cases():
    rng = random.Random(7)
    at = lambda: (rng.uniform(-9e6, 9e6), rng.uniform(-9e6, 9e6))
    lines = [(i, "a", g.LINE, [[[at() for _ in range(rng.choice((2, 3, 7)))]]]) for i in range(60)]
    lines.append((60, "a", g.LINE, [[[(0, 0), (2e6, 0), (0, 0), (0, 3e6), (0, 0)]]]))  # back and forth, upright
    lines.append((61, "a", g.MULTILINE, [[[(1e6, 1e6), (1e6, 1e6)]], [[(-4e6, 1e6), (4e6, 1e6)]]]))  # a single place, and a part of its own
    lines += [lines[0], (0, "b", *lines[0][2:])]  # one twice, and one of other fields
    places = [at() for _ in range(300)] + [(0, 0), (0, 0), (2e6, 1e5), (1e6, 1e6)]
    return lines, places


def test_counts_and_least_distances_of_every_hit(spark, monkeypatch):
    lines, places = cases()
    shapes, pts = features(spark, lines), points(spark, places)
    for tolerance in (0.0, 150_000.0, 2_500_000.0):
        hits = q.query_many(pts, shapes, tolerance).groupBy("pid").agg(F.count(F.lit(1)).alias("n"), F.min("distance").alias("d"))
        expected = {r["pid"]: (r["n"], round(r["d"], 3)) for r in hits.collect()}
        for rows in (1_000_000, 90):  # groups that are one, and groups that are cut
            monkeypatch.setattr(q, "COUNT_ROWS", rows)
            got = {r["pid"]: (r["lines"], round(r["nearest"], 3)) for r in q.count_lines(pts, shapes, tolerance).collect()}
            assert got == expected


def test_registered_query_makes_no_hits(spark):
    from cartoloom.plans import QUERIES

    plan = QUERIES["q07_query_many_lines"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan and "Join Inner, (_cell" not in plan


def test_pieces_give_what_one_gives(monkeypatch):
    rng = np.random.default_rng(3)
    px, py, ax, ay, bx, by = rng.uniform(0, 1e6, (6, 400))
    line = np.repeat(np.arange(100), 4)
    whole = reach.count_near(px, py, line, ax, ay, bx, by, 2e4)
    t = np.clip(((px[:, None] - ax) * (bx - ax) + (py[:, None] - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2), 0, 1)
    d = np.hypot(px[:, None] - ax - t * (bx - ax), py[:, None] - ay - t * (by - ay))
    assert (whole[0] == [len(set(line[row <= 2e4])) for row in d]).all()
    monkeypatch.setattr(reach, "TOGETHER", 50)
    cut = reach.count_near(px, py, line, ax, ay, bx, by, 2e4)
    assert (cut[0] == whole[0]).all() and (cut[1] == whole[1]).all()
