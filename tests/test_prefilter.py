"""Boxes around query points: none is lost, and features away from them are not read."""

import random

import pytest
from pyspark.sql import functions as F

from cartoloom.functions import geom as g
from cartoloom.functions import mercator as m
from cartoloom.operators import query as q

POINTS = "pid long, lon double, lat double"


@pytest.mark.parametrize("most", [1, 3, 8])
def test_boxes_hold_all_and_are_few(most):
    rng = random.Random(most)
    given = [(x, y, x + rng.random(), y + rng.random()) for x, y in ((rng.choice([0, 50, 90]) + rng.random(), rng.choice([0, 70]) + rng.random()) for _ in range(300))]
    boxes = q.prefilter_boxes(given, most)
    assert len(boxes) <= most
    assert all(any(b[0] <= x0 and b[1] <= y0 and b[2] >= x1 and b[3] >= y1 for b in boxes) for x0, y0, x1, y1 in given)
    if most > 6:  # six clusters and nothing between them
        assert len(boxes) >= 6 and sum((b[2] - b[0]) * (b[3] - b[1]) for b in boxes) <= 6 * 4


def test_no_points_and_one_place():
    assert q.prefilter_boxes([]) == []
    assert q.prefilter_boxes([(1, 2, 1, 2)] * 5) == [(1, 2, 1, 2)]
    assert q.prefilter_boxes([(x, y, x + 9, y + 9) for x in range(0, 100, 10) for y in range(0, 100, 10)]) == [(0, 0, 99, 99)]


def scanned(df):
    """Rows that the parquet scan of a plan without a shuffle gave."""
    df.collect()
    todo, rows = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        plan = todo.pop()
        if plan.nodeName().startswith("Scan parquet"):
            rows += plan.metrics().apply("numOutputRows").value()
        children = plan.children()
        todo += [children.apply(i) for i in range(children.size())]
    return rows


def test_row_groups_between_two_clusters_are_not_read(spark, tmp_path):
    n = 40_000
    x = (F.col("id") / n * 2 - 1) * m.HALF_WORLD  # stored from west to east
    shapes = spark.range(0, n, 1, 20).select(F.lit("l").alias("layer"), F.col("id").alias("fid"), g.point(x, F.lit(0.0)).alias("geom"))
    g.with_bounds(shapes).write.parquet(str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    rng = random.Random(1)
    places = [(-170 + rng.random(), 0.0) for _ in range(50)] + [(170 + rng.random(), 0.0) for _ in range(50)] + [(None, 3.0), (float("nan"), 0.0)]
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(places)], POINTS)
    near = q.near_points(stored, points, 1000.0)
    assert scanned(near) <= n // 5  # one box would hold nearly all
    got = sorted((r["pid"], r["fid"]) for r in q.query_many(points, stored, 1000.0).select("pid", "fid").collect())
    every = points.select("pid", m.merc_x("lon").alias("px"), m.merc_y("lat").alias("py")).join(F.broadcast(stored)).where(
        g.distance(F.col("px"), F.col("py"), F.col("geom.parts")[0][0][0]["x"], F.col("geom.parts")[0][0][0]["y"]) <= 1000.0)
    assert got == sorted((r["pid"], r["fid"]) for r in every.where(~F.isnan("px")).select("pid", "fid").collect()) and got
    assert q.near_points(stored, points.limit(0), 5.0).count() == n
