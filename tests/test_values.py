"""Exact values, and the paths that only hot groups take."""

import pytest
from pyspark.sql import functions as F

from cartoloom.functions import geom as g
from cartoloom.functions import skew
from cartoloom.operators import blend, burn, compose, export, features, grid, pack, project, query, raster, reports, tiles
from cartoloom.sources import readers


def one(df):
    return df.first().asDict()


def points(spark, rows, layer="a"):
    df = spark.createDataFrame(rows, "fid bigint, lon double, lat double")
    return readers.read_features(df, "lon", "lat", "fid", layer)


def test_tile_extent(spark):
    row = one(tiles.tile_extent(spark.createDataFrame([(9, 112, 195)], "z int, x int, y int")))
    want = (-11271098.44281895, 4696291.017841229, -11192826.925854929, 4774562.534805248)
    assert [row[c] for c in g.BOX] == pytest.approx(want, abs=1e-6)
    row = one(tiles.tile_buffered_extent(spark.createDataFrame([(9, 112, 195)], "z int, x int, y int")))
    want = (-11273544.427724076, 4693845.032936104, -11190380.940949803, 4777008.519710373)
    assert [row[c] for c in g.BOX] == pytest.approx(want, abs=1e-6)
    with pytest.raises(ValueError):
        tiles.tile_buffered_extent(spark.range(1), buffer=-4096)


def test_quantize_point(spark):
    out = tiles.tile_from_features(points(spark, [(1, -122.0, 48.0)]), 0, srs=4326)
    at = out.first()["tgeom"]["parts"][0][0][0]
    assert (at["x"], at["y"]) == (660.0, 1424.0)


def polygon(spark, wkt_rings, type_=g.POLYGON):
    """One polygon feature per list of parts of rings of (x, y)."""
    parts = [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in part] for part in wkt_rings]
    df = spark.createDataFrame([(1, (type_, parts))], f"fid bigint, geom {g.GEOM_TYPE}")
    return g.with_bounds(df.select(F.lit("p").alias("layer"), F.lit(0).alias("layer_ord"), "fid", "geom"))


SQUARE2 = [(-2, 2), (2, 2), (2, -2), (-2, -2), (-2, 2)]
SQUARE1 = [(-1, 1), (1, 1), (1, -1), (-1, -1), (-1, 1)]


def test_degenerate_shell(spark):
    bad = polygon(spark, [[[(-2, 2), (-2, 2)], SQUARE1]])
    assert tiles.tile_from_features(bad, 0, srs=4326).isEmpty()
    kept = tiles.tile_from_features(bad, 0, srs=4326, process_all_rings=True).first()["tgeom"]["parts"]
    assert {(v["x"], v["y"]) for v in kept[0][0]} == {(2037, 2059), (2037, 2037), (2059, 2037), (2059, 2059)}


def test_union_cover(spark):
    both = polygon(spark, [[SQUARE2], [SQUARE1]], g.MULTIPOLYGON)
    rows = burn.to_cells(both, (8, 8, (-4.0, -4.0, 4.0, 4.0)))
    assert burn.union_cover(rows, 8, 8, "positive", False).count() == 20
    assert burn.union_cover(rows, 8, 8, "positive").count() == 16
    assert burn.union_cover(rows, 8, 8, "evenOdd").count() == 12


def test_commands_round_trip(spark):
    want = [9, 8448, 255, 26, 0, 8704, 8703, 0, 0, 8703, 15]
    back = spark.range(1).select(pack.decode_commands(F.array(*[F.lit(c).cast("bigint") for c in want]), F.lit(3)).alias("tgeom"))
    assert pack.geometry_commands(back).first()["commands"] == want


def test_extent_filter_and_expression(spark):
    df = points(spark, [(1, 1.0, 1.0)])
    assert features.extent_filter(df, (-1, -1, 0, 0)).isEmpty()
    row = spark.createDataFrame([(1, 3, True)], "fid bigint, integer int, bool boolean")
    assert one(features.evaluate(row, "integer = :i AND bool = :b", {"i": 3.0, "b": True}))["result"] is True


def test_scale(spark):
    view = spark.createDataFrame([(4000, 4000, 0.0, 0.0, 1.0, 1.0)], "width int, height int, minx double, miny double, maxx double, maxy double")
    assert one(project.scale(view))["scale"] == 0.00025
    assert one(project.scale_denominator(view, True))["scale_denominator"] == pytest.approx(99392.40249399428)


def test_pixels(spark):
    px = spark.createDataFrame([(0, i, 0, v) for i, v in enumerate((12, -1, 99999, 256))], "img_id int, x int, y int, v bigint")
    blank = px.withColumn("v", F.lit(0).cast("bigint"))
    got = raster.set_pixel(blank, px, "gray16").orderBy("x")
    assert [r["v"] for r in got.collect()] == [12, 0, 65535, 256]
    g8 = raster.cast_copy(got, "gray8")
    assert [r["v"] for r in g8.orderBy("x").collect()] == [12, 0, 255, 255]
    assert [r["v"] for r in raster.cast_copy(g8, "gray16", 1, 2).orderBy("x").collect()] == [5, 0, 127, 127]


def test_blur(spark):
    px = spark.createDataFrame([(0, x, y, 255 if x == y == 1 else 0, 0, 0 if x == y == 1 else 255, 255) for x in range(3) for y in range(3)],
                               "img_id int, x int, y int, r int, g int, b int, a int")
    got = {(r["x"], r["y"]): r["rgba"] for r in blend.pack_rgba(raster.convolve(px, "blur")).collect()}
    assert all(got[x, y] == (4293001244 if y == 1 else 4291166264) for x in range(3) for y in range(3))


def test_hsl(spark):
    row = one(blend.hsl2rgb(spark.createDataFrame([(1 / 3, 1.0, 0.25098039215686274)], "h double, s double, l double")))
    assert (row["r"], row["g"], row["b"]) == (0, 128, 0)
    row = one(blend.rgb2hsl(spark.createDataFrame([(0, 128, 0)], "r int, g int, b int")))
    assert (row["h"], row["s"], row["l"]) == pytest.approx((1 / 3, 1, 0.25098039215686274), abs=1e-7)


def test_composite_drop_and_buffer(spark):
    north = tiles.tile_from_features(points(spark, [(1, -100.0, 60.0)], "na"), 1, srs=4326)
    south = tiles.tile_from_features(points(spark, [(2, -100.0, -60.0)], "sa"), 1, srs=4326)
    merged = compose.merge_tiles(north, north)
    assert merged.count() == north.count()
    assert compose.composite_same(north, [north, south]).count() == 2
    with pytest.raises(ValueError):
        compose.extract_layer(north, "missing")


def test_grid_errors(spark):
    cells = spark.createDataFrame([(0, 0, 0, "1")], "grid_id bigint, x bigint, y bigint, key string")
    with pytest.raises(ValueError):
        grid.encode_utf(cells, 4, 4, resolution=0)


def test_geojson_error(spark):
    bad = spark.createDataFrame([('{"type":"Point","coordinates":[1,2]}',)], "text string")
    with pytest.raises(Exception, match="GeoJSON"):
        export.from_geojson_table(bad, "text").collect()


def test_hot_cells_keep_every_pair(spark):
    pts = spark.range(300).select(F.col("id").alias("pid"), (F.when(F.col("id") < 200, 1.0).otherwise(F.col("id") / 10.0)).alias("lon"), F.lit(1.0).alias("lat"))
    fs = spark.range(200).select(F.col("id").alias("fid"), F.when(F.col("id") < 150, 1.0).otherwise(F.col("id") / 10.0).alias("lon"), F.lit(1.0).alias("lat"))
    feats = project.reproject(readers.read_features(fs, "lon", "lat", "fid"), 4326, 3857)
    got = sorted((r["pid"], r["fid"]) for r in query.query_many(pts, feats, 1000.0).collect())
    lon_p = [1.0 if i < 200 else i / 10.0 for i in range(300)]
    lon_f = [1.0 if i < 150 else i / 10.0 for i in range(200)]
    assert got == [(p, f) for p in range(300) for f in range(200) if abs(lon_p[p] - lon_f[f]) < 0.005]


def test_chunks_and_dense_index(spark):
    df = spark.range(1000).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id").alias("fid"))
    order = {k: [i for i in range(1000) if (i % 3 == 0) == k] for k in (0, 1)}
    want = sorted((k, i, at // 10) for k in order for at, i in enumerate(order[k]))
    hits = df.select("k", "fid", F.lit(1.0).alias("distance"), F.lit(0).alias("pid"))
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    for coalesce, parts in (("true", "8"), ("false", "8"), ("false", "3")):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        assert sorted(tuple(r) for r in skew.chunked(df, ["k"], ["fid"], 10).select("k", "fid", "chunk").collect()) == want
        arrays = query.hits_by_point(hits, 300).orderBy("part").collect()
        assert [len(r["hits"]) for r in arrays] == [300, 300, 300, 100]
        assert [h["fid"] for r in arrays for h in r["hits"]] == list(range(1000))
    for c, v in before.items():
        spark.conf.set(c, v)
    idx = [r["i"] for r in skew.dense_index(df, ["fid"], "i").orderBy("fid").collect()]
    assert idx == list(range(1000))


def test_blend_blocks_agree(spark):
    layers = spark.range(10 * 4).select(
        F.lit(0).alias("canvas_id"), (F.col("id") / 4).cast("int").alias("ord"), F.lit(0).alias("off_x"), F.lit(0).alias("off_y"),
        (F.col("id") % 2).cast("int").alias("x"), (F.col("id") / 2 % 2).cast("int").alias("y"),
        *[(F.col("id") * k % 256).cast("int").alias(c) for k, c in zip((7, 31, 113, 67), "rgba")])
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(blend.blend_stack(layers, 2, 2, block=3)) == key(blend.blend_stack(layers, 2, 2)) == key(blend.blend_stack(layers, 2, 2, skip_covered=True))


HOLED = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]


@pytest.mark.parametrize("hole, wrong", [
    ([(0, 5), (4, 7), (4, 3), (0, 5)], False),  # touches the shell in one point
    ([(-2, 5), (4, 7), (4, 3), (-2, 5)], True),  # crosses it
    ([(0, 2), (0, 8), (4, 5), (0, 2)], True),  # shares a stretch with it
])
def test_rings_may_touch(spark, hole, wrong):
    found = reports.validity_report(polygon(spark, [[HOLED, hole]]), "geom").where(F.col("message") == reports.SELF_CROSSING)
    assert (not found.isEmpty()) == wrong


def lines(spark, rows):
    """Lines of (x, y), all with the id 1."""
    data = [(1, (g.LINE, [[[{"x": float(x), "y": float(y)} for x, y in line]]])) for line in rows]
    df = spark.createDataFrame(data, f"fid bigint, geom {g.GEOM_TYPE}")
    return g.with_bounds(df.select(F.lit("p").alias("layer"), F.lit(0).alias("layer_ord"), "fid", "geom"))


def test_repeated_ids_stay_apart(spark):
    df = lines(spark, [[(0, 0), (5, 0.1), (10, 0)], [(0, 50), (5, 90), (10, 50)]])
    got = tiles.simplify(df, 1.0, "geom").collect()
    assert sorted([(v["x"], v["y"]) for v in r["geom"]["parts"][0][0]] for r in got) == [[(0, 0), (10, 0)], [(0, 50), (5, 90), (10, 50)]]
    hits = query.query_many(spark.createDataFrame([(7, 0.0, 0.0)], "pid bigint, lon double, lat double"), df, 1000.0)
    assert sorted(round(r["distance"], 3) for r in hits.collect()) == [0.0, 50.0]


@pytest.mark.parametrize("text", ['{"type":"Point","coordinates":[1,2]}', '{"type":"Feature","id":1,"geometry":null,"properties":{}}'])
def test_geojson_documents_that_are_no_features(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="GeoJSON"):
        readers.read_geojson(spark, str(tmp_path)).collect()
