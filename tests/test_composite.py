"""Composite with options and mixed zooms, raster layers, and merges of versions."""

import pytest
from pyspark.sql import functions as F

from cartoloom.functions import geom as g
from cartoloom.operators import compose, pack

SCHEMA = f"z int, x int, y int, layer string, layer_ord int, fid bigint, gtype int, props map<string,string>, tgeom {g.GEOM_TYPE}"
HALF = 20037508.342789244


def vs(points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def table(spark, *rows):
    """Rows ``(tile, layer, fid, type, parts)``, parts of rings of points."""
    kinds = {g.POINT: 1, g.LINE: 2, g.POLYGON: 3}
    return spark.createDataFrame([(*t, layer, 0, fid, kinds[kind], {}, (kind, [[vs(r) for r in part] for part in parts])) for t, layer, fid, kind, parts in rows], SCHEMA)


def box(lo, hi):
    return [(lo, lo), (hi, lo), (hi, hi), (lo, hi), (lo, lo)]


def rings(df):
    return {r["fid"]: [[[(v["x"], v["y"]) for v in ring] for ring in part] for part in r["tgeom"]["parts"]] for r in df.collect()}


def test_options_apply_to_rebuilt_tiles_only(spark):
    none = table(spark)
    line = [(0, 0), (100, 3), (200, 0), (300, 400)]
    src = table(spark, ((1, 0, 0), "a", 1, g.LINE, [[line]]), ((1, 0, 0), "b", 2, g.POLYGON, [[[(9, 9), (9, 9)], box(20, 60)]]))
    passed = rings(compose.composite(none, [(src, 1)], 1, simplify_distance=10.0))
    assert passed[1] == [[line]] and len(passed[2][0]) == 2
    rebuilt = rings(compose.composite(none, [(src, 1)], 1, reencode=True, simplify_distance=10.0, process_all_rings=True))
    assert rebuilt[1] == [[[(0, 0), (200, 0), (300, 400)]]]
    assert sorted(set(rebuilt[2][0][0])) == [(20, 20), (20, 60), (60, 20), (60, 60)]
    assert set(rings(compose.composite(none, [(src, 1)], 1, reencode=True))) == {1}  # a bad shell takes its hole along


def test_max_extent_cuts_and_drops(spark):
    src = table(spark, ((1, 0, 0), "a", 1, g.LINE, [[[(0, 100), (4096, 100)]]]), ((1, 1, 0), "a", 2, g.LINE, [[[(300, 100), (4096, 100)]]]))
    west = (-HALF, -HALF, -HALF / 2, HALF)  # the western half of tile 1/0/0; only the edge of 1/1/0's buffer is far from it
    out = rings(compose.composite(table(spark), [(src, 1)], 1, reencode=True, max_extent=west))
    assert out == {1: [[[(0, 100), (2048, 100)]]]}
    for bad in ((1, 2, 3), ()):
        with pytest.raises(ValueError):
            compose.composite(table(spark), [(src, 1)], 1, reencode=True, max_extent=bad)
    with pytest.raises(ValueError):
        compose.composite(table(spark), [(src, 1)], 1, reencode=True, scale_factor=0)


def test_a_layer_comes_from_the_first_tile_that_leaves_features(spark):
    near, far = [[[(10, 10)]]], [[[(4095, 4095)]]]
    zero = table(spark, ((0, 0, 0), "a", 1, g.POINT, far), ((0, 0, 0), "b", 2, g.POINT, near))
    one = table(spark, ((1, 0, 0), "a", 3, g.POINT, near), ((1, 0, 0), "b", 4, g.POINT, near), ((1, 1, 1), "a", 5, g.POINT, near))
    two = table(spark, ((2, 3, 3), "a", 6, g.POINT, near), ((2, 0, 1), "c", 7, g.POINT, near))
    got = compose.composite(table(spark), [zero.unionByName(two), one], 1).select("x", "y", "layer", "fid").collect()
    assert sorted(map(tuple, got)) == [(0, 0, "a", 3), (0, 0, "b", 2), (0, 0, "c", 7), (1, 1, "a", 1)]
    # the target comes first, and empty sources change nothing
    got = compose.composite(one, [zero, table(spark)], 1).select("fid").collect()
    assert sorted(r[0] for r in got) == [3, 4, 5]


def test_rasters_of_other_zooms(spark):
    cell = "z int, x int, y int, layer string, cx int, cy int, v int"
    zero = spark.createDataFrame([(0, 0, 0, "r", i % 2, i // 2, i) for i in range(4)], cell)
    down = compose.composite_rasters(zero.where("false"), [zero], 1, 2)
    assert sorted(map(tuple, down.select("x", "y", "cx", "cy", "v").collect())) == sorted((x, y, i, j, 2 * y + x) for x in (0, 1) for y in (0, 1) for i in (0, 1) for j in (0, 1))
    two = spark.createDataFrame([(2, x, 0, "s", i % 2, i // 2, 10 * x + i) for x in (0, 1) for i in range(4)], cell)
    up = compose.composite_rasters(zero, [two, zero], 0, 2).orderBy("layer", "cy", "cx").select("layer", "cx", "cy", "v").collect()
    assert [tuple(r) for r in up if r["layer"] == "r"] == [("r", i % 2, i // 2, i) for i in range(4)]
    assert [tuple(r) for r in up if r["layer"] == "s"] == []  # a cell of zoom 0 looks at cell 2 of each 4: none of these tiles has it
    up = compose.composite_rasters(zero.where("false"), [two], 1, 2).select("x", "y", "layer", "cx", "cy", "v").collect()
    assert [tuple(r) for r in up] == [(0, 0, "s", 0, 0, 3)]  # the first tile wins its layer
    half = compose.composite_rasters(zero.where("false"), [zero], 1, 2, max_extent=(-HALF, -HALF, 0.0, HALF))
    assert {r["x"] for r in half.collect()} == {0}


def test_versions_of_merged_layers(spark):
    point = [[[(10, 10)]]]
    a = pack.pack_tiles(table(spark, ((0, 0, 0), "a", 1, g.POINT, point)))
    b = pack.pack_tiles(table(spark, ((0, 0, 0), "a", 2, g.POINT, point), ((0, 0, 0), "b", 3, g.POINT, point), ((0, 0, 0), "c", 4, g.POINT, point)))
    b = b.withColumn("version", F.when(F.col("layer") == "b", 1).when(F.col("layer") == "c", F.lit(None)).otherwise(2)).withColumn(
        "features", F.when(F.col("layer") == "c", F.slice("features", 1, 0)).otherwise(F.col("features")))
    plain = {r["layer"]: r["version"] for r in compose.merge_tiles(a, b).collect()}
    assert plain == {"a": 2, "b": 1, "c": None}
    with pytest.raises(ValueError):
        compose.merge_tiles(a, b, validate=True)
    raised = {r["layer"]: r["version"] for r in compose.merge_tiles(a, b, validate=True, upgrade=True).collect()}
    assert raised == {"a": 2, "b": 2}
    three = b.withColumn("version", F.when(F.col("layer") == "b", 3).otherwise(2)).where("layer <> 'c'")
    with pytest.raises(ValueError):
        compose.merge_tiles(a, three.withColumn("layer_ord", F.ascii("layer")), validate=True, upgrade=True)
