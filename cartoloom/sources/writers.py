"""Sinks for features, tiles and grids."""

from pyspark.sql import functions as F

from ..functions.skew import chunked
from ..operators import export, grid, pack

#: Bytes of a row group of packed tiles.
ROW_GROUP = 4 << 20


def write_geojson(df, path, per_document=10_000, digits=12):
    """FeatureCollection documents, one per line, in one folder per layer.

    A layer is cut into documents of ``per_document`` features, so no row has
    to hold a large layer whole.
    """
    texts = df.select("layer", "fid", export.feature_json("fid", "geom", export.properties_json(df), digits).alias("text"))
    docs = chunked(texts, ["layer"], ["fid", "text"], per_document).groupBy("layer", "chunk").agg(
        F.sort_array(F.collect_list(F.struct("fid", "text"))).alias("f")
    )
    body = F.array_join(F.transform("f", lambda s: s["text"]), ",")
    docs.select("layer", F.concat(F.lit('{"type":"FeatureCollection","features":['), body, F.lit("]}")).alias("value")) \
        .write.mode("errorifexists").partitionBy("layer").text(path)


def write_tiles(tiles, path, compression="zstd", per_row=10_000):
    """Packed tiles as parquet, one folder per zoom, compressed or not (``none``).

    Files are range partitioned by tile, so a reader of few tiles skips row groups. A row holds up to ``per_row`` features
    and a reader decodes a row group at once, so row groups are small and their size is looked at from the first row on.
    """
    pack.pack_tiles(tiles, per_row).repartitionByRange("z", "x", "y", "layer", "part") \
        .sortWithinPartitions("z", "x", "y", "layer", "part") \
        .write.mode("errorifexists").option("compression", compression) \
        .option("parquet.block.size", ROW_GROUP).option("parquet.page.size.row.check.min", 1).option("parquet.page.size.row.check.max", 100) \
        .partitionBy("z").parquet(path)


def write_grid_json(cells, width, height, path, resolution=4, data=None):
    """One ``{grid, keys, data}`` document per grid."""
    grid.grid_documents(cells, width, height, resolution, data).select("document") \
        .write.mode("errorifexists").text(path)
