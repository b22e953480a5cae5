"""Palettes against all pairs of colours and entries; fill rules in one pass; packing with many attributes."""

import random

import pytest
from pyspark.sql import functions as F

from cartoloom.functions import geom as g
from cartoloom.operators import blend, burn, pack


def image(spark, colours):
    rows = [(1, i, 0, *c) for i, c in enumerate(colours)]
    return spark.createDataFrame(rows, "img_id int, x int, y int, r int, g int, b int, a int")


def distance(p, q):
    return sum((u - v) ** 2 for u, v in zip(p, q))


@pytest.mark.parametrize("size", [1, 7, 256])
def test_palette_map_finds_the_nearest_entry(spark, size):
    rng = random.Random(size)
    palette = [tuple(rng.randrange(256) for _ in range(4)) for _ in range(size)]
    palette[-1] = palette[0]  # a tie goes to the first
    colours = [tuple(rng.randrange(256) for _ in range(4)) for _ in range(1500)] + palette + [(0, 0, 0, 0), (255, 255, 255, 255)]
    got = {r["x"]: r["palette_index"] for r in blend.palette_map(image(spark, colours), palette).collect()}
    want = {x: min(range(size), key=lambda i: (distance(c, palette[i]), i)) for x, c in enumerate(colours)}
    assert got == want


def test_palette_map_without_cells_or_channels(spark):
    assert blend.palette_map(image(spark, []), [(1, 2, 3, 4)]).isEmpty()
    assert blend.palette_map(image(spark, [(1, None, 2, 3)]), [(1, 2, 3, 4)]).first()["palette_index"] is None
    for palette in ([], [(0, 0, 0, 0)] * 257):
        with pytest.raises(ValueError):
            blend.palette_map(image(spark, []), palette)


def test_palette_cube_holds_few_entries(spark):
    rng = random.Random(5)
    entries = F.array(*[F.struct(*[F.lit(rng.randrange(256)).alias(c) for c in "rgba"], F.lit(i).alias("i")) for i in range(256)])
    held = blend._palette_cube(spark, entries).agg(F.count(F.lit(1)).alias("cells"), F.avg(F.size("_candidates")).alias("mean")).first()
    assert held["cells"] == 4096 and held["mean"] < 64


def test_octree_keeps_rare_hues_of_a_smooth_image(spark):
    rng = random.Random(3)
    smooth = [(x, 255 - x, x // 2, 255) for x in range(256) for _ in range(6)]
    rare = [(0, 0, 255, 255), (255, 0, 0, 255)]
    noise = [tuple(rng.randrange(256) for _ in range(3)) + (255,) for _ in range(400)]
    for n in (2, 16, 64, 256):
        colours = smooth + rare + noise
        out = blend.palette_of(image(spark, colours), n).collect()
        palette = [(r["r"], r["g"], r["b"]) for r in out]
        assert 0 < len(out) <= n and sum(r["cells"] for r in out) == len(colours)
        depth = max(d for d in range(9) if len({tuple(v >> (8 - d) for v in c[:3]) for c in colours}) <= n)
        side = 256 >> depth
        assert all(min(distance(c[:3], p) for p in palette) <= 3 * side**2 for c in colours)


def test_octree_of_few_or_close_colours(spark):
    few = [(1, 2, 3, 4), (1, 2, 3, 8), (200, 9, 9, 9)]
    out = sorted(tuple(r) for r in blend.palette_of(image(spark, few), 5).collect())
    assert out == [(1, 2, 3, 6, 2), (200, 9, 9, 9, 1)]
    close = [(100 + i % 4, 100 + i // 4 % 4, 100, 255) for i in range(16)]  # one node of depth 6
    assert 2 <= blend.palette_of(image(spark, close), 4).count() <= 4
    assert blend.palette_of(image(spark, []), 4).isEmpty()
    assert blend.palette_of(image(spark, [(None, 1, 1, 1)]), 4).isEmpty()


def test_rules_in_one_pass_are_those_of_each_rule(spark):
    def ring(lo, hi, turned):
        box = [(lo, lo), (hi, lo), (hi, hi), (lo, hi), (lo, lo)]
        return [{"x": float(x), "y": float(y)} for x, y in (box[::-1] if turned else box)]

    parts = [[ring(0, 9, False), ring(2, 5, True)], [ring(3, 8, False)]]
    df = spark.createDataFrame([(1, (g.MULTIPOLYGON, parts)), (2, (g.POLYGON, [[ring(1, 4, True)]]))], f"fid bigint, _cells {g.GEOM_TYPE}")
    for by_part in (True, False):
        both = burn.polygon_cells(df, 12, 12, ["fid"], burn.FILL_RULES, by_part).select("rule", "fid", "x", "y").collect()
        for rule in burn.FILL_RULES:
            alone = burn.polygon_cells(df, 12, 12, ["fid"], rule, by_part).select(F.lit(rule), "fid", "x", "y").collect()
            assert sorted(tuple(r) for r in both if r["rule"] == rule) == sorted(tuple(r) for r in alone)
    with pytest.raises(ValueError):
        burn.polygon_cells(df, 12, 12, ["fid"], ["odd"])


def packed_bytes(spark, attributes, vertices=20_000, features=8):
    """Shuffled bytes of packing features with long lines, and the packed rows."""
    line = F.transform(F.sequence(F.lit(0), F.lit(vertices - 1)), lambda i: g.vertex((i * 7919 + F.col("fid")) % 4096, (i * 104729) % 4096))
    props = F.map_from_arrays(F.array(*[F.lit(f"k{i:02d}") for i in range(attributes)]), F.array(*[F.concat(F.lit(f"v{i}-"), "fid") for i in range(attributes)]))
    tiles = spark.range(features).select(
        F.lit(0).alias("z"), F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit("roads").alias("layer"), F.lit(0).alias("layer_ord"), F.col("id").alias("fid"))
    tiles = tiles.withColumns({"gtype": F.lit(2), "props": props, "tgeom": g.line(line)})
    store = spark.sparkContext._jsc.sc().statusStore()
    seen = max([0, *stages(store)])
    rows = pack.pack_tiles(tiles).collect()
    return sum(size for i, size in stages(store).items() if i > seen), rows


def stages(store):
    listed = store.stageList(None, False, False, getattr(store, "stageList$default$4")(), None)
    return {listed.apply(i).stageId(): listed.apply(i).shuffleWriteBytes() for i in range(listed.size())}


def test_packing_moves_a_geometry_once_per_feature(spark):
    one, _ = packed_bytes(spark, 1)
    many, rows = packed_bytes(spark, 30)
    assert one > 0 and many < 1.2 * one
    assert len(rows) == 1 and len(rows[0]["keys"]) == 30 and len(rows[0]["values"]) == 240
    assert all(len(f["tags"]) == 60 and len(f["geometry"]) == 2 * 20_000 + 2 for f in rows[0]["features"])
