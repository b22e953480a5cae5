"""Hits ranked in the cells that make them."""

import random

from pyspark.sql import functions as F

from cartoloom.functions import geom as g
from cartoloom.operators import query as q
from cartoloom.plans import QUERIES

from test_query_cover import features, points


def test_ranks_of_every_hit(spark, monkeypatch):
    rng = random.Random(5)
    at = lambda: (rng.gauss(0, 400_000), rng.gauss(0, 400_000))
    shapes = features(spark, [(i, "a", g.POINT, [[[at()]]]) for i in range(200)])
    pts = points(spark, [at() for _ in range(60)] + [(0, 0), (0, 0)])
    expected = {}
    for r in sorted(q.query_many(pts, shapes, 150_000.0).collect(), key=lambda r: (r["pid"], r["distance"], r["fid"])):
        expected.setdefault(r["pid"], []).append(r["fid"])
    for pairs in (1_000_000, 300):  # cells that are whole, and cells that are cut
        monkeypatch.setattr(q, "RANK_PAIRS", pairs)
        got = {}
        for r in sorted(q.ranked_hits(pts, shapes, 150_000.0).collect(), key=lambda r: (r["pid"], r["rank"])):
            assert r["rank"] == len(got.setdefault(r["pid"], []))
            got[r["pid"]].append(r["fid"])
        assert got == expected


def test_hits_are_not_shuffled(spark):
    out = QUERIES["q08_hits_by_point"](spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("SortMergeJoin")]
    assert "Window" in above and "Exchange" not in above
