"""Lines are cut in Arrow batches, with the results of the column expression."""

import random

from pyspark.sql import functions as F

from cartoloom.functions import geom as g
from cartoloom.operators import tiles
from cartoloom.plans import QUERIES

BOX = (0.0, 0.0, 10.0, 10.0)


def table(spark, shapes):
    rows = [(i, (kind, [[[(x, y) for x, y in line]] for line in lines])) for i, (kind, lines) in enumerate(shapes)]
    return spark.createDataFrame(rows, f"fid long, tgeom {g.GEOM_TYPE}")


def by_expression(df):
    """The pieces of each line, by ``tiles.clip_line``."""
    box = [F.lit(c) for c in BOX]
    pieces = F.flatten(F.transform(F.flatten("tgeom.parts"), lambda r: tiles.clip_line(r, box)))
    return {r["fid"]: r["p"] for r in df.select("fid", pieces.alias("p")).collect() if r["p"]}


def test_lines_equal_the_expression(spark):
    rng = random.Random(7)
    spot = lambda: float(rng.choice([rng.randint(-5, 15), 0, 10, rng.uniform(-5, 15)]))
    shapes = [(g.MULTILINE if k > 1 else g.LINE, [[(spot(), spot()) for _ in range(rng.randint(1, 9))] for _ in range(k)]) for k in (1, 1, 1, 2, 3) * 60]
    shapes += [(g.LINE, [[(5.0, 5.0), (5.0, 5.0), (20.0, 5.0), (20.0, 5.0), (5.0, 5.0)]]), (g.LINE, [[(1.0, None), (2.0, 2.0), (30.0, 2.0)]]), (g.LINE, [[]])]
    df = table(spark, shapes).repartition(3)
    inside = {r["fid"] for r in df.where(tiles._within("tgeom", [F.lit(c) for c in BOX])).collect()}
    want = by_expression(df.where(~F.col("fid").isin(list(inside))))
    got = {r["fid"]: r["tgeom"] for r in tiles.clip_points_lines(df, BOX).collect()}
    assert set(got) == set(want) | inside
    for fid, pieces in want.items():
        assert [p[0] for p in got[fid]["parts"]] == pieces and got[fid]["type"] == (g.LINE if len(pieces) == 1 else g.MULTILINE)
    given = {r["fid"]: r["tgeom"] for r in df.collect()}
    assert all(got[fid] == given[fid] for fid in inside)


def test_box_of_columns(spark):
    df = table(spark, [(g.LINE, [[(-5.0, 1.0), (5.0, 1.0)]])] * 2).withColumn("side", F.col("fid") + 1.0)
    got = {r["fid"]: r["tgeom"]["parts"][0][0] for r in tiles.clip_points_lines(df, (0, 0, "side", "side")).collect()}
    assert [[tuple(v) for v in got[i]] for i in (0, 1)] == [[(0.0, 1.0), (1.0, 1.0)], [(0.0, 1.0), (2.0, 1.0)]]


def test_lines_are_cut_in_batches(spark):
    plan = QUERIES["t08_clip_points_lines"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan
