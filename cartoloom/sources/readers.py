"""Feature tables from files and tables (S01-S04), tiles from parquet."""

from pyspark.sql import functions as F

from ..functions import geom as g
from ..operators import export, pack


def read_features(df, x="x", y="y", fid=None, layer="features", layer_ord=0):
    """Point features from any table; the remaining columns become attributes.

    Without an id column the key is only unique, not dense, and it depends on
    the input files' layout.
    """
    fid_col = F.col(fid) if fid else F.monotonically_increasing_id()
    attrs = [c for c in df.columns if c not in (x, y, fid)]
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    return df.select(
        F.lit(layer).alias("layer"), F.lit(layer_ord).alias("layer_ord"), fid_col.cast("bigint").alias("fid"),
        *attrs, g.point(px, py).alias("geom"),
        px.alias("minx"), py.alias("miny"), px.alias("maxx"), py.alias("maxy"),
    )


def read_points_csv(spark, path, x="x", y="y", fid=None, layer="csv", schema=None, **options):
    """Delimited text with a header. Give ``schema`` for large inputs: without it the file is read twice."""
    reader = spark.read.option("header", True).option("mode", "FAILFAST").options(**options)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return read_features(reader.csv(path), x, y, fid, layer)


COLLECTION_SCHEMA = f"{export.FEATURE_SCHEMA}, features array<string>, _bad string"


def read_geojson(spark, path, layer="geojson", multiline=False):
    """FeatureCollection or Feature documents to feature rows.

    Bad JSON, any other kind of document and a feature without a geometry are
    errors, inside a collection or not. A geometry collection keeps its
    geometries in ``members``.

    One document per line splits over tasks; ``multiline`` reads each file as
    one document, so large inputs should come as many files or as lines.
    """
    reader = spark.read.schema(COLLECTION_SCHEMA).option("mode", "FAILFAST").option("multiLine", multiline)
    docs = reader.json(path)
    texts = docs.where(F.col("type") == "FeatureCollection").select(F.explode("features").alias("text"))
    rows = export.from_geojson_table(texts, "text")
    bad = F.raise_error(F.concat(F.lit("Failed to read GeoJSON document of type "), F.coalesce("type", F.lit("null"))))
    single = export.with_geometry(docs.where(~F.col("type").eqNullSafe("FeatureCollection")), "geometry").select(
        F.col("id").alias("fid"), F.col("properties").alias("props"),
        F.when((F.col("type") == "Feature") & F.isnotnull("geom"), F.col("geom")).otherwise(bad.cast(g.GEOM_TYPE)).alias("geom"), "members",
    )
    rows = rows.unionByName(g.with_bounds(single))
    return rows.select(F.lit(layer).alias("layer"), F.lit(0).alias("layer_ord"), *rows.columns)


def sql_source(spark, query, variables=None, **tables):
    """Sub-select with named variables: ``:name`` in the text is a typed literal, ``{table}`` a DataFrame."""
    return spark.sql(query, args=variables or {}, **tables)


def read_tiles(spark, path):
    """Packed tiles back to tile-feature rows."""
    return pack.unpack_tiles(spark.read.parquet(path))
