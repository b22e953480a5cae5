"""Inspecting, merging and combining tiles."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geom as g
from ..functions import mercator as m
from ..functions import skew
from . import export, raster, tiles as tl
from .tiles import BUFFER, SIZE, TILE

LAYER = (*TILE, "layer")


def names(tiles):
    """Ordered distinct layer names per tile (one entry per layer, not per feature)."""
    per_layer = tiles.groupBy(*LAYER).agg(F.min("layer_ord").alias("layer_ord"))
    ordered = F.array_sort(F.collect_list(F.struct("layer_ord", "layer")))
    return per_layer.groupBy(*TILE).agg(ordered.alias("_l")).select(*TILE, F.transform("_l", lambda s: s["layer"]).alias("names"))


def extract_layer(tiles, name):
    found = tiles.where(F.col("layer") == name)
    if found.limit(1).isEmpty():
        raise ValueError(f"layer does not exist in tile: {name!r}")
    return found


def layer_presence(tiles, requested):
    """Per tile and requested layer: how many features it has.

    ``requested`` has one row per tile and layer asked for.
    """
    counts = tiles.groupBy(*LAYER).agg(F.count(F.lit(1)).alias("features"))
    return requested.join(counts, list(LAYER), "left").withColumn("features", F.coalesce("features", F.lit(0)))


def painted_layers(tiles, requested):
    return layer_presence(tiles, requested).where(F.col("features") > 0).select(*LAYER)


def empty_layers(tiles, requested):
    return layer_presence(tiles, requested).where(F.col("features") == 0).select(*LAYER)


def tile_flags(tiles, requested):
    """``painted`` and ``empty`` per tile."""
    return layer_presence(tiles, requested).groupBy(*TILE).agg(
        (F.max("features") > 0).alias("painted"), (F.max("features") == 0).alias("empty"),
    )


def clear(tiles, ids):
    """Remove all layers of the given tiles."""
    return tiles.join(ids.select(*TILE).distinct(), list(TILE), "left_anti")


def tiles_to_geojson(tiles, mode="__all__", per_document=10_000, digits=12, size=SIZE):
    """GeoJSON text per tile: ``__all__`` one collection, ``__array__`` one per layer with its name,
    or the layer of a name or of an index. Geometry outside the tile stays.

    A tile above ``per_document`` features takes several documents (``part``).
    """
    if isinstance(mode, int) and not isinstance(mode, bool):
        picked = names(tiles).select(*TILE, F.get("names", F.lit(mode)).alias("layer")).where(F.col("layer").isNotNull())
        tiles = tiles.join(picked, list(LAYER))
    elif mode not in ("__all__", "__array__"):
        tiles = extract_layer(tiles, mode)
    keys = list(TILE) if mode == "__all__" else list(LAYER)
    text = export.feature_json("fid", "geom", F.to_json("props"), digits)
    rows = tl.dequantize(tiles, size).select(*LAYER, "layer_ord", "fid", text.alias("text"))
    docs = skew.chunked(rows, keys, ["layer_ord", "fid", "text"], per_document, "part").groupBy(*keys, "part").agg(
        F.array_sort(F.collect_list(F.struct("layer_ord", "fid", "text"))).alias("f"), F.count(F.lit(1)).alias("features")
    )
    body = F.array_join(F.transform("f", lambda s: s["text"]), ",")
    head = F.lit('{"type":"FeatureCollection",')
    if mode != "__all__":
        head = F.concat(head, F.lit('"name":'), F.to_json(F.struct("layer")).substr(F.lit(10), F.length(F.to_json(F.struct("layer"))) - 10), F.lit(","))
    return docs.select(*keys, "part", "features", F.concat(head, F.lit('"features":['), body, F.lit("]}")).alias("geojson"))


def tile_info(tiles):
    """Feature counts per layer and geometry kind."""
    n = lambda k, alias: F.count_if(F.col("gtype") == k).alias(alias)
    return tiles.groupBy(*LAYER).agg(
        F.count(F.lit(1)).alias("features"), n(1, "point_features"), n(2, "linestring_features"), n(3, "polygon_features"),
        F.count_if(~F.col("gtype").isin(1, 2, 3, 4)).alias("unknown_features"), n(4, "raster_features"),
    )


# The texts of layer and tile errors.
ERROR_VERSION = "Vector Tile Layer message has an unsupported version"
ERROR_NO_FEATURES = "Vector Tile Layer message has no features"
ERROR_REPEATED = "Vector Tile message has two or more layers with the same name"
ERROR_VERSIONS = "Vector Tile message has layers with different versions"


def tile_errors(layers):
    """Errors from layer headers ``(z, x, y, pos, layer, version, features)``; ``pos`` null for tile errors.

    As in the reference, the version test looks at the tile's *first* layer and
    never fires on that layer itself.
    """
    per_tile = layers.groupBy(*TILE).agg(
        F.min(F.struct("pos", "version")).alias("first"),
        (F.min("version") != F.max("version")).alias("mixed"),
    )
    repeated = layers.where(F.col("layer") != "").groupBy(*LAYER).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    joined = layers.join(per_tile, list(TILE))
    bad_version = (F.col("pos") != F.col("first.pos")) & ((F.col("first.version") > 2) | (F.col("first.version") < 1))
    layer_errors = joined.select(
        *TILE, "pos", "layer",
        F.explode(F.array_compact(F.array(
            F.when(bad_version, ERROR_VERSION), F.when(F.col("features") == 0, ERROR_NO_FEATURES),
        ))).alias("error"),
    )
    no_pos = F.lit(None).cast("int").alias("pos")
    no_layer = F.lit(None).cast("string").alias("layer")
    return (
        layer_errors
        .unionByName(repeated.select(*TILE).distinct().select(*TILE, no_pos, no_layer, F.lit(ERROR_REPEATED).alias("error")))
        .unionByName(per_tile.where("mixed").select(*TILE, no_pos, no_layer, F.lit(ERROR_VERSIONS).alias("error")))
    )


def layer_headers(tiles, version=2):
    """Layer headers of a tile-feature table or of packed tiles, in layer order.

    A table without a ``version`` column is of ``version``; a null version is 1, as a layer that doesn't say has it.
    """
    features = F.sum(F.size("features")) if "features" in tiles.columns else F.count(F.lit(1))
    held = F.min(F.coalesce("version", F.lit(1))) if "version" in tiles.columns else F.lit(version)
    per_layer = tiles.groupBy(*LAYER).agg(F.min("layer_ord").alias("pos"), features.alias("features"), held.alias("version"))
    return per_layer.select(*LAYER, "pos", "version", "features")


def upgrade_tiles(tiles):
    """Layers of version 1 (or of none) become version 2; layers without features go."""
    if "features" in tiles.columns:
        tiles = tiles.where(F.size("features") > 0)
    if "version" in tiles.columns:
        old = F.coalesce("version", F.lit(1)) == 1
        tiles = tiles.withColumn("version", F.when(old, 2).otherwise(F.col("version")).cast("int"))
    return tiles


def merge_tiles(a, b, validate=False, upgrade=False, b_headers=None):
    """Append b's layers whose names a does not have; both are tile-feature tables or both packed tiles.

    ``validate`` raises on an error of b's layers, whose headers may be given as ``b_headers``. ``upgrade`` brings b to
    version 2 first, which drops its layers without features; a's layers stay as they are.
    """
    if upgrade:
        b = upgrade_tiles(b)
        b_headers = None if b_headers is None else upgrade_tiles(b_headers.where(F.col("features") > 0).withColumnRenamed("features", "_n")).withColumnRenamed("_n", "features")
    if validate:
        headers = layer_headers(b) if b_headers is None else b_headers
        bad = tile_errors(headers).select("error").limit(1).collect()
        if bad:
            raise ValueError(bad[0]["error"])
    new = b.join(a.select(*LAYER).distinct(), list(LAYER), "left_anti")
    return a.unionByName(new)


def replace_tiles(a, b):
    """b's data replaces a's for the same tile."""
    return clear(a, b).unionByName(b)


def _first_source_wins(rows):
    """Keep a layer's rows from its first source only (column ``_src``)."""
    winner = rows.groupBy(*LAYER).agg(F.min("_src").alias("_win"))
    joined = rows.join(winner, list(LAYER))
    return joined.where(F.col("_src") == F.col("_win")).drop("_src", "_win")


def composite_same(target, sources):
    """Same z/x/y: concatenate layers; the first layer of a name wins."""
    out = None
    for i, df in enumerate([target, *sources]):
        df = df.withColumn("_src", F.lit(i))
        out = df if out is None else out.unionByName(df)
    return _first_source_wins(out)


def _move(df, factor, dx, dy, geom="tgeom"):
    """Scale and shift tile coordinates and round them to the grid."""
    near = lambda v: F.floor(v + 0.5)
    return df.withColumn(geom, g.map_vertices(geom, lambda x, y: (near(x * factor + dx), near(y * factor + dy))))


def _tile_box(df, size, buffer, max_extent):
    """The box that a tile's features are cut to: the buffered tile, within ``max_extent`` (mercator) put on its grid.

    A maximum extent gives each row its own box in columns; rows of tiles outside it go.
    """
    box = (-buffer, -buffer, size + buffer, size + buffer)
    if max_extent is None:
        return df, box
    if len(max_extent) != 4:
        raise ValueError("max_extent value must be an array of [minx,miny,maxx,maxy]")
    minx, miny, maxx, maxy = (F.lit(float(v)) for v in max_extent)
    n = m.n_tiles("z")
    at_x = lambda v: F.floor((m.world_u(v) * n - F.col("x")) * size + 0.5)
    at_y = lambda v: F.floor((m.world_v(v) * n - F.col("y")) * size + 0.5)
    low, high = (F.lit(float(v)) for v in (box[0], box[2]))
    sides = (F.greatest(low, at_x(minx)), F.greatest(low, at_y(maxy)), F.least(high, at_x(maxx)), F.least(high, at_y(miny)))
    names = [f"_box{i}" for i in range(4)]
    df = df.withColumns({k: v.cast("double") for k, v in zip(names, sides)})
    return df.where((F.col(names[0]) <= F.col(names[2])) & (F.col(names[1]) <= F.col(names[3]))), names


def _finish(df, size=SIZE, buffer=BUFFER, area_threshold=0.1, max_extent=None, simplify_distance=0.0, process_all_rings=False,
            scale_factor=1.0, offset_x=0.0, offset_y=0.0):
    """Scale, cut, simplify and filter features in tile coordinates; all but ``simplify_distance`` work row by row."""
    if scale_factor <= 0:
        raise ValueError("scale must be a positive non-zero number")
    tl.check_tile(size, buffer)
    columns = df.columns
    if (scale_factor, offset_x, offset_y) != (1.0, 0.0, 0.0):
        df = _move(df, scale_factor, offset_x, offset_y)
    df, box = _tile_box(df, size, buffer, max_extent)
    if process_all_rings:
        df = tl.drop_degenerate(df, True)  # before a bad shell could take its holes along
    out = tl.clip_polygons(tl.clip_points_lines(df, box), box)
    out = tl.simplify(out, simplify_distance)
    return tl.drop_degenerate(tl.drop_small_polygons(out, area_threshold), process_all_rings).select(*columns)


def _to_children(tiles, zoom, size, buffer):
    """Copies of features in the tiles of a deeper zoom that their envelope meets, found from tile coordinates."""
    factor = F.pow(F.lit(2.0), F.lit(zoom) - F.col("z"))
    b = g.bounds("tgeom")
    pad = buffer / size
    last = (factor - 1).cast("bigint")

    def children(lo, hi):
        first, final = F.ceil(F.col(lo) / size * F.col("_k") - pad - 1), F.floor(F.col(hi) / size * F.col("_k") + pad)
        lo_c, hi_c = F.greatest(first, F.lit(0)), F.least(final, F.col("_last"))
        return F.when(lo_c <= hi_c, F.sequence(lo_c, hi_c))

    rows = tiles.where(F.col("z") <= zoom).withColumns({"_k": factor, "_last": last, **{f"_{n}": c for n, c in b.items()}})
    rows = rows.withColumn("_cy", F.explode(children("_miny", "_maxy"))).withColumn("_cx", F.explode(children("_minx", "_maxx")))
    moved = _move(rows, F.col("_k"), -F.col("_cx") * size, -F.col("_cy") * size)
    moved = moved.withColumns({
        "x": (F.col("x") * F.col("_k") + F.col("_cx")).cast("int"), "y": (F.col("y") * F.col("_k") + F.col("_cy")).cast("int"),
        "z": F.lit(zoom),
    })
    return moved.select(*tiles.columns)


def _to_ancestors(tiles, zoom, size):
    """Features in the coordinates of the tile of a lower zoom that holds their tile."""
    k = F.pow(F.lit(2.0), F.greatest(F.col("z") - zoom, F.lit(0))).cast("bigint")  # never 0, also where rows are filtered out
    rows = tiles.where(F.col("z") >= zoom).withColumn("_k", k)
    rows = rows.withColumns({"_ax": F.floor(F.col("x") / F.col("_k")), "_ay": F.floor(F.col("y") / F.col("_k"))})
    moved = _move(
        rows, 1 / F.col("_k"),
        (F.col("x") - F.col("_ax") * F.col("_k")) * size / F.col("_k"), (F.col("y") - F.col("_ay") * F.col("_k")) * size / F.col("_k"),
    )
    return moved.withColumns({"x": F.col("_ax").cast("int"), "y": F.col("_ay").cast("int"), "z": F.lit(zoom)}).select(*tiles.columns)


def _origin(i):
    return F.struct(F.lit(i).alias("source"), "z", "x", "y")


def composite_overzoom(tiles, zoom, size=SIZE, buffer=BUFFER, **opts):
    """Child tiles from their ancestors: rescale and clip; features outside the buffered child go. No shuffle."""
    return _finish(_to_children(tiles, zoom, size, buffer), size, buffer, **opts)


def composite_underzoom(tiles, zoom, size=SIZE, buffer=BUFFER, **opts):
    """Mosaic of tiles into their ancestors; a layer name is taken from its first source tile."""
    moved = _to_ancestors(tiles.withColumn("_src", _origin(0)), zoom, size)
    return _finish(_first_source_wins(moved), size, buffer, **opts)


def composite(target, sources, zoom, reencode=False, size=SIZE, buffer=BUFFER, **opts):
    """Bring sources to the tiles of ``zoom`` and append the layers that a tile doesn't have yet.

    A source is a frame of tiles of any zooms, or a pair of it and its only zoom, which saves the other paths. Tiles of
    ``zoom`` pass through unless ``reencode`` asks for a rebuild; those above and below are rescaled, and rebuilt. A layer
    of a tile comes from the target, else from the first source and there from the first tile (by zoom, column and row) that
    leaves a feature of it.

    Options of rebuilt tiles: ``max_extent`` in mercator, ``simplify_distance``, ``area_threshold``, ``process_all_rings``,
    ``scale_factor``, ``offset_x`` and ``offset_y``.
    """
    out, moved = target.withColumn("_src", _origin(0)), []
    for i, source in enumerate(sources, 1):
        df, z = source if isinstance(source, tuple) else (source, None)
        rows = df.withColumn("_src", _origin(i))
        if z is None or z == zoom:
            here = rows.where(F.col("z") == zoom)
            if reencode:
                moved.append(here)
            else:
                out = out.unionByName(here)
        if z is None or z < zoom:
            moved.append(_to_children(rows.where(F.col("z") < zoom), zoom, size, buffer))
        if z is None or z > zoom:
            moved.append(_to_ancestors(rows.where(F.col("z") > zoom), zoom, size))
    if moved:
        rebuilt = _finish(reduce(DataFrame.unionByName, moved), size, buffer, **opts)
        out = out.unionByName(tl.orient_rings(rebuilt))
    return _first_source_wins(out)


def reencode_tiles(tiles, size=SIZE, buffer=BUFFER, **opts):
    """Rebuild tiles in place: quantize, clip and filter again."""
    again = tl.quantize(tl.dequantize(tiles, size, 3857), size).drop("geom")
    return tl.orient_rings(_finish(again, size, buffer, **opts)).select(*tiles.columns)


def composite_rasters(target, sources, zoom, size, max_extent=None):
    """Raster layers of any zooms brought to the tiles of ``zoom``, as :func:`composite` does with features.

    Rasters have one row per cell (tile, ``layer``, ``cx``, ``cy`` and values) and ``size`` x ``size`` cells a tile. A cell
    of a deeper tile shows the cell that holds it; a cell of a lower zoom shows the source cell at its middle. Both follow
    from whole numbers, so cells move without a join. Cells whose middle is outside ``max_extent`` (mercator) go.
    """
    if size <= 0:
        raise ValueError("Image width and height must be greater than zero")
    out, columns = target.withColumn("_src", _origin(0)), target.columns
    for i, df in enumerate(sources, 1):
        rows = df.withColumn("_src", _origin(i))
        same = rows.where(F.col("z") == zoom).select(*columns, "_src")
        k = F.pow(F.lit(2.0), F.abs(F.col("z") - zoom)).cast("bigint")
        moved = rows.where(F.col("z") != zoom).withColumns({"_k": k, "_gx": F.col("x").cast("bigint") * size + F.col("cx"), "_gy": F.col("y").cast("bigint") * size + F.col("cy")})
        middle = F.expr("pmod(_gx, _k) = _k div 2 and pmod(_gy, _k) = _k div 2")
        up = moved.where((F.col("z") > zoom) & middle).withColumns({"_gx": F.expr("_gx div _k"), "_gy": F.expr("_gy div _k")})
        down = moved.where(F.col("z") < zoom)
        for axis in ("_gy", "_gx"):
            down = down.withColumn(axis, F.explode(F.sequence(F.col(axis) * F.col("_k"), (F.col(axis) + 1) * F.col("_k") - 1)))
        at = {"x": "_gx", "y": "_gy"}
        moved = up.unionByName(down).withColumns({
            "z": F.lit(zoom), **{a: F.expr(f"cast({v} div {size} as int)") for a, v in at.items()}, **{f"c{a}": F.expr(f"cast({v} % {size} as int)") for a, v in at.items()}})
        if max_extent is not None:
            minx, miny, maxx, maxy = (F.lit(float(v)) for v in max_extent)
            n = m.n_tiles("z") * size
            u, w = (F.col("_gx") + 0.5) / n, (F.col("_gy") + 0.5) / n
            moved = moved.where(u.between(m.world_u(minx), m.world_u(maxx)) & w.between(m.world_v(maxy), m.world_v(miny)))
        out = out.unionByName(same).unionByName(moved.select(*columns, "_src"))
    return _first_source_wins(out)


def add_raster_layer(raster_tiles, images, placement, name, size, method="near"):
    """Attach images as a raster layer: ``placement`` maps ``img_id`` to a tile.

    Cells are resampled to ``size`` x ``size``; a zero size is an error.
    """
    if size <= 0:
        raise ValueError("Image width and height must be greater than zero")
    resized = raster.resize_near(images, size, size) if method == "near" else raster.resize_bilinear(images, size, size)
    cells = resized.withColumnsRenamed({"x": "cx", "y": "cy"})
    placed = cells.join(placement.select("img_id", *TILE), "img_id").drop("img_id").withColumn("layer", F.lit(name))
    return placed if raster_tiles is None else raster_tiles.unionByName(placed)
