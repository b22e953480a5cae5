"""Rings of groups that are traced in one task, and of those that are spread."""

import random

from cartoloom.operators import outline

from test_outline import SIDE, frame, spiral


def by_key(rings):
    return {(r["k"], r["fid"]): r["_cells"].asDict(True) for r in rings.collect()}


def test_traced_and_spread_rings_are_the_same(spark, monkeypatch):
    rng = random.Random(5)
    cells = [(f if f % 7 else None, "ab"[f % 2], rng.randrange(1 + f % 13), rng.randrange(1 + f % 11)) for f in range(40) for _ in range(rng.randrange(1, 120))]
    cells = spark.createDataFrame(cells, "fid bigint, k string, x int, y int")
    traced = by_key(outline.cover_rings(cells, ["k", "fid"]))
    monkeypatch.setattr(outline, "MOST", 8)  # smaller groups stay whole
    assert by_key(outline.cover_rings(cells, ["k", "fid"])) == traced and len(traced) > 30


def test_sides_of_small_groups_are_not_written(spark, monkeypatch):
    """Each round over the sides wrote all of them, which filled the disk; runs are written once."""
    kept, rows = outline.skew.checkpoint, []

    def counted(df):
        out = kept(df)
        rows.append(out.count())
        return out

    monkeypatch.setattr(outline.skew, "checkpoint", counted)
    assert outline.cover_rings(frame(spark, {1: spiral(SIDE), 2: {(0, 0)}})).count() == 2
    assert sum(rows) < SIDE
