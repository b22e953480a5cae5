"""Counts of lines near places where places or segments are odd, and what the query shuffles."""

import numpy as np

from cartoloom.operators import reach


def test_segments_are_not_spread_over_cells(spark):
    """A row for every cell that a segment passes made most of the work on large tables."""
    from cartoloom.plans import QUERIES

    plan = QUERIES["q07_query_many_lines"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan and "_cell" not in plan


def test_heaps_points_and_edges_of_the_tolerance():
    rng = np.random.default_rng(9)
    px, py = np.concatenate((rng.uniform(-1e7, 1e7, (60, 2)), rng.uniform(0, 3e4, (900, 2)), np.full((80, 2), 5e5))).T  # far apart, a heap, one place
    ends = rng.uniform(-1e7, 1e7, (300, 4))
    ends[:100] = rng.uniform(-2e4, 5e4, (100, 4))  # short ones inside the heap
    ends[100:140, 2:] = ends[100:140, :2]  # single places
    ends[140] = 5e5, 5e5, 5e5, 5e5
    ends[141], ends[142] = (-1e7, 5.2e5, 1e7, 5.2e5), (5.2e5, -1e7, 5.2e5, 1e7)  # just within the tolerance of one place
    ends[143], ends[144] = (-1e7, 5.2e5 + 1e-6, 1e7, 5.2e5 + 1e-6), (np.nan, 0, 1, 1)
    line = rng.permutation(np.repeat(np.arange(150), 2))
    ax, ay, bx, by = ends.T
    dx, dy = bx - ax, by - ay
    square = np.where(dx * dx + dy * dy == 0, 1.0, dx * dx + dy * dy)
    t = np.clip(((px[:, None] - ax) * dx + (py[:, None] - ay) * dy) / square, 0.0, 1.0)
    away = np.sqrt((px[:, None] - (ax + t * dx)) ** 2 + (py[:, None] - (ay + t * dy)) ** 2)
    for tolerance in (0.0, 2e4, 3e6):
        found, best = reach.count_near(px, py, line, ax, ay, bx, by, tolerance)
        hit = away <= tolerance
        assert (found == [len(set(line[row])) for row in hit]).all()
        assert (best == np.where(hit, away, np.inf).min(axis=1)).all()
    assert reach.count_near(px[:0], py[:0], line, ax, ay, bx, by, 1.0)[0].size == 0
