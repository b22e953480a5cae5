"""Key grids: rasterize, encode and inspect (U). Cell table: ``grid_id, x, y, key``."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geom as g
from . import burn


def grid_key(df, key="__id__"):
    """Choose the grid key: the feature id, or any attribute."""
    if key != "__id__" and key not in df.columns:
        raise ValueError(f"no such key: {key!r}")
    return df.withColumn("key", F.col("fid" if key == "__id__" else key).cast("string"))


def _last_drawn(cells, value="key"):
    """The last drawn feature of each cell: an aggregate, combined before its shuffle."""
    return burn.last_drawn(cells, ["grid_id", "x", "y"], value).withColumn(value, F.col(value).cast("string"))


def _prepare(df, view, key):
    rows = grid_key(df, key)
    if key == "__id__":
        rows = rows.withColumn("key", F.col("fid"))  # a number until the last one of a cell is known
    if "grid_id" not in df.columns:
        rows = rows.withColumn("grid_id", F.lit(0).cast("bigint"))
    return burn.to_cells(rows, view)


KEEP = ("grid_id", "layer_ord", "fid", "key")


def rasterize_points(df, view, key="__id__"):
    """Point features to cells; later features overwrite earlier ones."""
    return _last_drawn(burn.point_cells(_prepare(df, view, key), view[0], view[1], KEEP))


def rasterize_polygons(df, view, key="__id__", rule="evenOdd"):
    return _last_drawn(burn.polygon_cells(_prepare(df, view, key), view[0], view[1], KEEP, rule))


def rasterize_lines(df, view, key="__id__"):
    return _last_drawn(burn.line_cells(_prepare(df, view, key), view[0], view[1], KEEP))


def rasterize(df, view, key="__id__"):
    """Features of all kinds onto one grid."""
    return _last_drawn(burn.all_cells(_prepare(df, view, key), view[0], view[1], KEEP))


def dense_grid(cells, width, height, step=1):
    """Complete grids; unpainted cells have the key ''.

    Blank cells are generated per grid and merged by one aggregate, since ''
    sorts before every key.
    """
    if width <= 0 or height <= 0:
        raise ValueError("width and height must be greater than zero")
    every = lambda n: F.explode(F.sequence(*[F.lit(i).cast("bigint") for i in (0, n - 1, step)]))
    blank = cells.select("grid_id").distinct().withColumn("y", every(height)).withColumn("x", every(width)).withColumn("key", F.lit(""))
    sampled = cells if step == 1 else cells.where((F.col("x") % step == 0) & (F.col("y") % step == 0))
    rows = sampled.select("grid_id", "x", "y", "key").unionByName(blank)
    return rows.groupBy("grid_id", "x", "y").agg(F.max("key").alias("key"))


def _check_resolution(resolution):
    if resolution < 1:
        raise ValueError("'resolution' must be a positive integer")


def _code_point(i):
    """Code points from 32 on, leaving out 34 and 92."""
    return F.when(i < 2, i + 32).when(i < 59, i + 33).otherwise(i + 34)


def encode_keys(cells, width, height, resolution=4):
    """Keys of the sampled cells in order of first appearance, with their code points."""
    _check_resolution(resolution)
    sampled = dense_grid(cells, width, height, resolution)
    first = sampled.groupBy("grid_id", "key").agg(F.min(F.col("y") * width + F.col("x")).alias("first"))
    # distinct keys of one grid: no more than its sampled cells
    i = F.row_number().over(Window.partitionBy("grid_id").orderBy("first")) - 1
    return first.select("grid_id", "key", i.alias("key_ord"), _code_point(i).alias("code"))


def encode_utf(cells, width, height, resolution=4):
    """One string per sampled row, one character per sampled cell."""
    keys = encode_keys(cells, width, height, resolution)
    sampled = dense_grid(cells, width, height, resolution)
    coded = sampled.join(keys, ["grid_id", "key"])
    char = F.decode(F.unhex(F.lpad(F.hex("code"), 8, "0")), "UTF-32")
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x", char.alias("c")))), lambda s: s["c"]), "")
    return coded.groupBy("grid_id", "y").agg(line.alias("line"))


def grid_data(cells, features, fields, key="__id__", resolution=None):
    """Attributes of the keys that appear, limited to ``fields``; ``__id__`` is the feature id.

    Keys for which no real field is asked have no entry.
    """
    real = [f for f in fields if f != "__id__" and f in features.columns]
    if not real:
        return features.sparkSession.createDataFrame([], "grid_id bigint, key string, data string")
    shown = cells if resolution is None else cells.where((F.col("x") % resolution == 0) & (F.col("y") % resolution == 0))
    present = shown.where(F.col("key") != "").select("grid_id", "key").distinct()
    cols = [F.col("fid").alias("__id__") if f == "__id__" else F.col(f) for f in fields if f == "__id__" or f in real]
    first = grid_key(features, key).groupBy("key").agg(F.min_by(F.to_json(F.struct(*cols)), F.struct("layer_ord", "fid")).alias("data"))
    return present.join(first, "key").select("grid_id", "key", "data")


def grid_documents(cells, width, height, resolution=4, data=None):
    """One ``{grid, keys, data}`` document per grid; its size is bounded by the sampled cells."""
    lines = encode_utf(cells, width, height, resolution).groupBy("grid_id").agg(F.array_sort(F.collect_list(F.struct("y", "line"))).alias("l"))
    keys = encode_keys(cells, width, height, resolution).groupBy("grid_id").agg(F.array_sort(F.collect_list(F.struct("key_ord", "key"))).alias("k"))
    out = lines.join(keys, "grid_id")
    body = F.lit("{}")
    if data is not None:
        entries = F.array_sort(F.collect_list(F.concat(F.to_json(F.struct("key")).substr(F.lit(8), F.length(F.to_json(F.struct("key"))) - 8), F.lit(":"), F.col("data"))))
        out = out.join(data.groupBy("grid_id").agg(F.concat(F.lit("{"), F.array_join(entries, ","), F.lit("}")).alias("d")), "grid_id", "left")
        body = F.coalesce("d", F.lit("{}"))
    head = F.to_json(F.struct(F.transform("l", lambda s: s["line"]).alias("grid"), F.transform("k", lambda s: s["key"]).alias("keys")))
    return out.select("grid_id", F.concat(head.substr(F.lit(1), F.length(head) - 1), F.lit(',"data":'), body, F.lit("}")).alias("document"))


def grid_view(cells, x, y, width, height):
    """A rectangle of every grid, moved to 0,0."""
    inside = F.col("x").between(x, x + width - 1) & F.col("y").between(y, y + height - 1)
    return cells.where(inside).withColumns({"x": F.col("x") - x, "y": F.col("y") - y})


def grid_is_solid(cells, width, height):
    """Per grid: are all cells equal, and to what. Cells without a row count as ''."""
    if width <= 0 or height <= 0:
        raise ValueError("view does not have valid dimensions")
    agg = cells.groupBy("grid_id").agg(F.min("key").alias("lo"), F.max("key").alias("hi"), F.count(F.lit(1)).alias("n"))
    solid = (F.col("lo") == F.col("hi")) & ((F.col("n") == width * height) | (F.col("hi") == ""))
    return agg.select("grid_id", solid.alias("solid"), F.when(solid, F.col("hi")).alias("value"))


def grid_get(cells, x, y):
    """The cell at a position; none outside."""
    return cells.where((F.col("x") == x) & (F.col("y") == y)).select("grid_id", "key")


def grid_painted(cells):
    return cells.groupBy("grid_id").agg((F.max("key") != "").alias("painted"))


def grid_clear(cells):
    return cells.withColumn("key", F.lit(""))


def tile_grid(tiles, layer, width=256, height=256, size=4096, key="__id__"):
    """A tile layer drawn onto one grid per tile, named ``z/x/y``."""
    rows = tiles.where(F.col("layer") == layer)
    rows = rows.withColumn("key", (F.col("fid") if key == "__id__" else F.col("props")[key]).cast("string"))
    rows = rows.withColumn("grid_id", F.concat_ws("/", "z", "x", "y"))
    rows = rows.withColumn("_cells", g.map_vertices("tgeom", lambda x, y: (x * width / size, y * height / size)))
    rows = rows.drop("x", "y").where(F.col("key").isNotNull())
    return _last_drawn(burn.all_cells(rows, width, height, KEEP))
